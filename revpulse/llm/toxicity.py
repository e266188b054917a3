"""Toxicity: a factorization machine over hashed terms of short windows.

A term is a lower-cased run of letters, or its first few bytes, so an inflected word is known by its stem;
terms are hashed into buckets. A window of ``WINDOW`` words is the set of
its terms, and its logit is ``bias + sum w_i + sum_{i<j} <v_i, v_j>``: pairs of terms have a weight of
their own, which additive weights cannot give. A text is as toxic as its most toxic window, so a few words
in a very long text count as much as in a short one. Windows are cut twice, half a window apart, so no pair
of neighbours is always separated. The empty window belongs to every text.

The model is fitted on a bounded sample of labelled texts, with the most toxic window standing for each
text (multiple-instance learning). Near copies share one weight: texts with the same least hash of a
5-word shingle count as one together. Terms that few texts have weigh nothing, and neither do those that
stand out neither alone nor in a pair. Alone, a term stands out if toxic texts have it far more or less often than
others. A pair, of words or word starts of ``STARTS[k], k in PAIR_KINDS``, stands out if windows of it are
more often toxic than its two terms alone let expect, or less often and one of them stands out alone.

Texts are looked at by Spark tasks only. Those count terms and pairs of terms, each text's once: first pairs in toxic texts,
then the pairs that can still stand out in the others. To the driver come the terms' counts, at most one
for each bucket, and in each epoch the most toxic window of each text of the sample. None of this grows with
the length of texts.

Defined results: a null or empty text, or one without letters, gets the score of the empty window.
Repeated rows get equal scores. Null labels are not learned from, a repeated label counts once, as its
least value; without both classes among the labels every score is the share of toxic labels (0.5 without
any). An empty table gives an empty result. ``keep`` passes other columns through whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import scratch, written
from .labelled import fold, sample_ids

#: Labelled texts that the model is fitted on, at most.
TRAINING_TEXTS = 4000
BUCKETS, WINDOW, FACTORS = 1 << 20, 32, 4
#: Texts of the sample that must have a term, and standard deviations by which their toxic share must stand
#: out, unless a pair of the term does. Others weigh nothing: with thousands of them the model would learn
#: wrong labels by heart.
LEAST_TEXTS, STANDS_OUT = 6, 5.0
#: Pairs that would stand out by chance if all pairs were additive, at most, as a Chernoff bound has it.
CHANCE_PAIRS = 1.0
#: Pairs that a task makes at once, distinct ones that it sums before it hands them on, and bits of the filter that
#: holds the pairs of the first count.
PAIRS_AT_ONCE, PAIRS_HELD, FILTER_BITS = 1 << 18, 1 << 19, 22
#: Bytes of texts that a task looks at together; what it makes of them takes a multiple of that.
TEXT_BYTES = 1 << 18
#: Lengths in bytes of the word starts that are terms beside the word (None) itself, and those that make pairs.
STARTS, PAIR_KINDS = (None, 4, 5, 6, 7, 8), (0, 2)
#: A text's weight of 1; weights are whole numbers, so their sums are the same in every order.
ONE = 1 << 32
EPOCHS, STEPS, RATE, DECAY = 8, 12, 0.1, 1e-3
#: Texts with at least this score are toxic.
THRESHOLD = 0.7

_CODES = W.byte_codes(fold_case=True)
_BETWEEN = ~(W.byte_set(bytes(range(65, 91))) | W.byte_set(bytes(range(97, 123))) | W.byte_set(bytes(range(128, 256))))


class Model(NamedTuple):
    bias: float
    place: np.ndarray  # by bucket: index of the term, or -1
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, windows: Windows) -> np.ndarray:
        """Of the most toxic window of each text."""
        best = np.full(windows.texts, self.bias)
        if len(windows.text):
            np.maximum.at(best, windows.text, self.bias + _interactions(windows, self.weights, self.factors)[0])
        return best


class Windows(NamedTuple):
    texts: int
    text: np.ndarray  # the text of each window that has a term
    window: np.ndarray  # window and term of each entry
    term: np.ndarray


def terms(starts: np.ndarray, data: np.ndarray) -> tuple[W.Words, np.ndarray]:
    """Words, and the buckets of each word's terms, a word after the other."""
    words = W.split_words(starts, data, _BETWEEN)
    hashes = W.hash_starts(words, _CODES, STARTS)
    return words, np.stack([(h >> np.uint64(44)).astype(np.int32) for h in hashes], axis=1)


def known_terms(counts: np.ndarray, buckets: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word in it, and index of every known term; ``counts`` has the number of words of each text."""
    found = place[buckets]
    word, kind = np.nonzero(found >= 0)
    first = np.append(0, np.cumsum(counts))
    owner = np.searchsorted(first, word, side="right") - 1
    return owner, word - first[owner], found[word, kind]


def cut_windows(counts: np.ndarray, owner: np.ndarray, at: np.ndarray, term: np.ndarray) -> Windows:
    """Distinct known terms of each window."""
    size = int(term.max(initial=0)) + 1
    # Each text has room for its windows of both cuts.
    room = np.append(0, np.cumsum(2 * (counts // WINDOW + 2)))
    entries = []
    for shift in (0, 1):
        window = room[owner] + 2 * ((at + shift * WINDOW // 2) // WINDOW) + shift
        entries.append(window * size + term)
    entries = np.unique(np.concatenate(entries))
    window, term = entries // size, entries % size
    ids, window = np.unique(window, return_inverse=True)
    return Windows(len(counts), np.searchsorted(room, ids, side="right") - 1, window, term)


def _interactions(windows: Windows, weights: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit of each window without the bias, and the sums of its terms' factors."""
    n = len(windows.text)
    linear = np.bincount(windows.window, weights[windows.term], n)
    sums = np.stack([np.bincount(windows.window, f[windows.term], n) for f in factors])
    squares = np.bincount(windows.window, (factors**2).sum(0)[windows.term], n)
    return linear + 0.5 * ((sums**2).sum(0) - squares), sums


def _only(windows: Windows, chosen: np.ndarray) -> Windows:
    index = np.full(len(windows.text), -1)
    index[chosen] = np.arange(len(chosen))
    inside = index[windows.window] >= 0
    return Windows(windows.texts, windows.text[chosen], index[windows.window[inside]], windows.term[inside])


def _most_toxic(windows: Windows, logits: np.ndarray) -> np.ndarray:
    """The window of the highest logit of each text that has one."""
    order = np.lexsort((logits, windows.text))
    return order[np.flatnonzero(np.diff(windows.text[order], append=-1))]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row and terms of each text of a batch, one text at a time."""
    for rows, starts, data in W.chunks(batch.column("text"), TEXT_BYTES):
        words, buckets = terms(starts, data)
        for k, (a, b) in enumerate(zip(words.first_word[:-1].tolist(), words.first_word[1:].tolist())):
            yield rows.start + k, buckets[a:b]


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of a 5-word shingle of each text, which near copies share."""
    for batch in batches:
        for rows, starts, data in W.chunks(batch.column("text"), TEXT_BYTES):
            words = W.split_words(starts, data, _BETWEEN)
            shingles, cut = W.hash_windows(W.hash_words(words, _CODES), 5), words.first_word
            family = [shingles[cut[k] : max(cut[k], cut[k + 1] - 4)] for k in range(len(starts) - 1)]
            least = pa.array([int(f.min() >> np.uint64(1)) if len(f) else None for f in family], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c)[rows] for c in ("doc_id", "label", "weight")), least], ["doc_id", "label", "weight", "family"])


def _term_counts(units: dict[int, int]):
    """Per task and bucket: weight of the texts that have it, of the toxic ones, and a mark of the words that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, toxic, marks = (np.zeros(BUCKETS, t) for t in (np.int64, np.int64, np.uint64))
        for batch in batches:
            ids, labels = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
            for row, buckets in _texts(batch):
                here = np.unique(buckets)
                every[here] += units[ids[row]]
                toxic[here] += units[ids[row]] * labels[row]
                with np.errstate(over="ignore"):
                    word = W.mix(np.arange(len(buckets), dtype=np.uint64) + W.mix(np.array([ids[row]], np.int64).view(np.uint64)))
                for n, kind in enumerate(PAIR_KINDS):
                    # A word has a term once, also if several of its starts are the same.
                    first = np.all(buckets[:, list(PAIR_KINDS[:n])] != buckets[:, kind, None], axis=1)
                    np.bitwise_xor.at(marks, buckets[first, kind], word[first])
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, every[some], toxic[some], marks[some].view(np.int64))], ["bucket", "every", "toxic", "mark"])

    return run


class Screen(NamedTuple):
    """What decides whether a pair stands out. Terms that the same words of the sample have are one class."""

    place: np.ndarray  # by bucket: its class, or -1 if it makes no pairs
    own: np.ndarray  # by class: its toxic share
    logit: np.ndarray  # by class: of that share if it stands out alone, of the mean if not
    strong: np.ndarray  # by class: whether it stands out alone, as toxic
    usable: np.ndarray  # by class: whether enough toxic texts have it for a pair of it to stand out
    base: float
    enough: float

    def expected(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic shares between which a pair does not stand out: the higher of its terms', and what they add up to."""
        low, high = np.divmod(pairs, len(self.own))
        added, higher = 1 / (1 + np.exp(self.base - self.logit[low] - self.logit[high])), np.maximum(self.own[low], self.own[high])
        return np.minimum(added, higher), np.maximum(added, higher)

    def with_strong(self, pairs: np.ndarray) -> np.ndarray:
        low, high = np.divmod(pairs, len(self.own))
        return self.strong[low] | self.strong[high]

    def possible(self, pairs: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Whether a pair can stand out; of pairs without a strong term the clean texts are not known yet."""
        lower, upper = self.expected(pairs)
        return (-toxic * np.log(upper) >= self.enough) | (self.with_strong(pairs) & (-clean * np.log1p(-lower) >= self.enough))

    def outstanding(self, pairs: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        every, (lower, upper) = clean + toxic, self.expected(pairs)
        seen = np.clip(toxic / np.maximum(every, 1e-9), 1e-9, 1 - 1e-9)
        near = np.clip(seen, lower, upper)
        bound = every * (seen * np.log(seen / near) + (1 - seen) * np.log((1 - seen) / (1 - near)))
        return (every >= LEAST_TEXTS) & (bound >= self.enough) & ((seen > near) | self.with_strong(pairs))


def screen_of(bucket: np.ndarray, every: np.ndarray, toxic: np.ndarray, mark: np.ndarray, alone: np.ndarray, share: float) -> Screen:
    """From the terms that are in enough texts: buckets, texts, toxic texts, marks of their words, and whether each stands out alone."""
    some = mark != 0
    kinds, first, of = np.unique(mark[some], return_index=True, return_inverse=True)
    place = np.full(BUCKETS, -1, np.int32)
    place[bucket[some]] = of
    n = len(kinds)
    own = ((toxic + share) / (every + 1))[some][first]
    base = float(np.log(share / (1 - share)))
    logit = np.where(alone[some][first], np.log(own / (1 - own)), base)
    enough = float(np.log(max(n * (n - 1) / 2 / CHANCE_PAIRS, 2.0)))
    strong = alone[some][first] & (own > share)
    return Screen(place, own, logit, strong, toxic[some][first] * -np.log(np.maximum(own, 1e-9)) >= enough, base, enough)


def text_pairs(windows: Windows, n: int, both: np.ndarray, either: np.ndarray) -> Iterator[np.ndarray]:
    """``low * n + high`` of pairs of terms in a common window of one text, each once.

    Of a pair both terms have to be marked in ``both``, or one of them in ``either``. Of a long text the pairs are
    made in parts by their lower term, so no more than about ``PAIRS_AT_ONCE`` are held.
    """
    window, term = windows.window, windows.term
    # Terms that are not in ``both`` are of use in windows with one of ``either`` only.
    chosen = np.bincount(window, either[term], len(windows.text))[window] > 0 if len(term) else np.zeros(0, bool)
    keep = both[term] | chosen
    window, term = window[keep], term[keep]
    sizes = np.bincount(window, minlength=len(windows.text))
    followers = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(term)) - 1
    parts = max(1, -(-int(followers.sum()) // PAIRS_AT_ONCE))
    for part in range(parts):
        entries = np.flatnonzero(term % parts == part) if parts > 1 else np.arange(len(term))
        found, begin, made = np.zeros(0, np.int64), 0, np.cumsum(followers[entries])
        while begin < len(entries):
            done = made[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(made, done + PAIRS_AT_ONCE, side="right")))
            some = entries[begin:end]
            low = np.repeat(term[some], followers[some])
            high = term[W.gather(some + 1, followers[some])]
            wanted = (both[low] & both[high]) | either[low] | either[high]
            found = np.unique(np.concatenate([found, low[wanted].astype(np.int64) * n + high[wanted]]))
            begin = end
        if len(found):
            yield found


def _slots(pairs: np.ndarray) -> np.ndarray:
    return (W.mix(pairs.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


class _Sums:
    """Pairs with their weights, summed as they come in; ``flush`` gives what is held."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = self.distinct = 0

    def add(self, pairs: np.ndarray, clean: int, toxic: int) -> Iterator[pa.RecordBatch]:
        self.parts.append((pairs, np.full(len(pairs), clean), np.full(len(pairs), toxic)))
        self.held += len(pairs)
        if self.held >= self.distinct + PAIRS_HELD // 2:
            columns = [np.concatenate(x) for x in zip(*self.parts)]
            self.parts.clear()
            order = np.argsort(columns[0], kind="stable")
            pairs = columns[0][order]
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            self.parts.append((pairs[first], *(np.add.reduceat(x[order], first) for x in columns[1:])))
            self.held = self.distinct = len(first)
            if self.distinct >= PAIRS_HELD:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        for part in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in part], ["pair", "clean", "toxic"])
        self.parts, self.held, self.distinct = [], 0, 0


def _pair_counts(screen: Screen, units: dict[int, int], filter_: np.ndarray | None = None):
    """Weights of the texts that have a pair: pairs with a strong term, and in toxic texts pairs of usable terms.

    With a filter: pairs of usable terms without a strong one that pass it, in the texts that are not toxic.
    """
    n, none = len(screen.own), np.zeros(len(screen.own), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            ids, labels = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
            for row, buckets in _texts(batch):
                is_toxic = bool(labels[row])
                if filter_ is not None and is_toxic:
                    continue
                _, at, term = known_terms(np.array([len(buckets)]), buckets[:, list(PAIR_KINDS)], screen.place)
                windows = cut_windows(np.array([len(buckets)]), np.zeros(len(at), np.int64), at, term)
                both = screen.usable & ~screen.strong if filter_ is not None else screen.usable if is_toxic else none
                for pairs in text_pairs(windows, n, both, none if filter_ is not None else screen.strong):
                    if filter_ is not None:
                        pairs = pairs[filter_[_slots(pairs)]]
                    yield from sums.add(pairs, 0 if is_toxic else units[ids[row]], units[ids[row]] if is_toxic else 0)
        yield from sums.flush()

    return run


_COUNTED = "pair long, clean long, toxic long"


def _kept_pairs(test):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, clean, toxic = (batch.column(c).to_numpy() for c in ("pair", "clean", "toxic"))
            yield batch.filter(pa.array(test(pairs, clean / ONE, toxic / ONE)))

    return run


def _distinct_numbers(numbers_of, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(numbers_of(batch.column("pair").to_numpy())), pa.int64())], [name])

    return run


def pair_terms(sample: DataFrame, screen: Screen, units: dict[int, int], folder: str) -> np.ndarray:
    """Classes of the terms with a pair that stands out."""
    n, summed = len(screen.own), [F.sum(c).alias(c) for c in ("clean", "toxic")]
    if n < 2:
        return np.zeros(0, np.int64)
    first = sample.mapInArrow(_pair_counts(screen, units), _COUNTED).groupBy("pair").agg(*summed)
    possible = written(first.mapInArrow(_kept_pairs(screen.possible), _COUNTED), f"{folder}/possible")
    # At most 2 ** FILTER_BITS numbers.
    slots = possible.mapInArrow(_distinct_numbers(_slots, "slot"), "slot long").distinct().toArrow()
    filter_ = np.zeros(1 << FILTER_BITS, bool)
    filter_[slots.column("slot").to_numpy()] = True
    shared = sample.sparkSession.sparkContext.broadcast((screen, filter_))

    def others(batches):
        screen, filter_ = shared.value
        return _pair_counts(screen, units, filter_)(batches)

    rest = sample.mapInArrow(others, _COUNTED).groupBy("pair").agg(F.sum("clean").alias("more"))
    counted = possible.join(rest, "pair", "left").select("pair", (F.col("clean") + F.coalesce("more", F.lit(0))).alias("clean"), "toxic")
    kept, terms_of = _kept_pairs(screen.outstanding), _distinct_numbers(lambda pairs: np.concatenate(np.divmod(pairs, n)), "term")
    # One step and not two: each Python step of a task holds a worker, which keeps its memory for the stages after it.
    found = counted.mapInArrow(lambda batches: terms_of(kept(batches)), "term long")
    return found.distinct().toArrow().column("term").to_numpy()


def _most_toxic_terms(place: np.ndarray, weights: np.ndarray, factors: np.ndarray):
    """The terms of the most toxic window of each text, if it has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text"), TEXT_BYTES):
                words, buckets = terms(starts, data)
                windows = cut_windows(words.counts, *known_terms(words.counts, buckets, place))
                if not len(windows.text):
                    continue
                part = _only(windows, _most_toxic(windows, _interactions(windows, weights, factors)[0]))
                order = np.argsort(part.window, kind="stable")
                cut = np.searchsorted(part.window[order], np.arange(len(part.text) + 1))
                found = part.term[order].astype(np.int32)
                ids = batch.column("doc_id")[rows].take(pa.array(part.text))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found))], ["doc_id", "terms"])

    return run


def fit(place: np.ndarray, odds: np.ndarray, ids: np.ndarray, weight: np.ndarray, y: np.ndarray, find, seed: int = 7) -> Model:
    """Adam on the log loss of each text's most toxic window, which is looked for anew in each epoch.

    ``find(weights, factors)`` gives ``doc_id`` and ``terms`` of these windows; ``ids`` are sorted.
    """
    rng = np.random.default_rng(seed)
    w = odds.copy()
    v = rng.normal(0, 0.02, (FACTORS, len(odds)))
    b, moments, step = -2.0, {}, 0

    def adam(name, value, gradient):
        m, s = moments.get(name, (0.0, 0.0))
        m, s = 0.9 * m + 0.1 * gradient, 0.99 * s + 0.01 * gradient**2
        moments[name] = (m, s)
        return value - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-4)

    for _ in range(EPOCHS):
        rows = find(w, v).sort_by("doc_id")
        text = np.searchsorted(ids, rows.column("doc_id").to_numpy())
        found = rows.column("terms").combine_chunks()
        many = np.diff(found.offsets.to_numpy())
        part = Windows(len(ids), text, np.repeat(np.arange(len(text)), many), found.flatten().to_numpy())
        goal = y[part.text]
        # The empty window of a text that is not toxic is not toxic either.
        empty, each_text = weight[y == 0].sum(), weight[part.text] / weight.sum()
        for _ in range(STEPS):
            step += 1
            value, sums = _interactions(part, w, v)
            error = (1 / (1 + np.exp(-(b + value))) - goal) * each_text
            each, rate = error[part.window], 1 / (1 + np.exp(-b))
            slope_w = np.bincount(part.term, each, len(w)) + DECAY * (w - odds)  # alone, a term keeps its odds
            slope_v = np.stack(
                [np.bincount(part.term, each * (sums[k][part.window] - v[k][part.term]), len(w)) for k in range(FACTORS)]
            ) + DECAY * v
            b = adam("b", b, error.sum() + rate * empty / weight.sum())
            w, v = adam("w", w, slope_w), adam("v", v, slope_v)
    return Model(float(b), place, w, v)


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1) -> Model:
    """The model of a bounded sample of the labelled texts; the fold ``held_out`` is not learned from."""
    folder = scratch(docs.sparkSession)
    usable = labels.where(F.col(label).isNotNull() & (fold("doc_id", folds) != held_out))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    chosen = F.broadcast(sample_ids(usable, TRAINING_TEXTS, "label"))  # at most TRAINING_TEXTS rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    # Of several texts with one id the one with the least hash is learned from.
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "label", "weight", "text")).alias("row")
    sample = written(texts.groupBy("doc_id").agg(least).select("doc_id", "row.label", "row.weight", "row.text"), f"{folder}/sample")
    rows = sample.mapInArrow(_families, "doc_id long, label int, weight double, family long").toArrow().sort_by("doc_id")
    ids, y, class_weight = (rows.column(c).to_numpy() for c in ("doc_id", "label", "weight"))
    y = y.astype(float)
    family = rows.column("family").to_pylist()
    copies = Counter(family)
    unit = np.array([ONE if f is None else round(ONE / copies[f]) for f in family], np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(float(np.log(share / (1 - share))), place, np.zeros(1), np.zeros((FACTORS, 1)))
    weight = unit / ONE * class_weight
    true_share = float(np.clip(np.average(y, weights=weight), 0.001, 0.99))
    # Terms and pairs are judged within the sample, whose classes are not as often as among all texts.
    share = float(np.clip(np.average(y, weights=unit), 0.01, 0.99))
    units = dict(zip(ids.tolist(), unit.tolist()))
    counted = sample.mapInArrow(_term_counts(units), "bucket long, every long, toxic long, mark long").groupBy("bucket")
    counted = counted.agg(F.sum("every").alias("every"), F.sum("toxic").alias("toxic"), F.bit_xor("mark").alias("mark"))
    found = counted.where(F.col("every") >= int(LEAST_TEXTS * ONE * (1 - 1e-6))).toArrow().sort_by("bucket")  # at most BUCKETS rows
    bucket, every, toxic, mark = (found.column(c).to_numpy() for c in ("bucket", "every", "toxic", "mark"))
    every, toxic = every / ONE, toxic / ONE
    surprise = (toxic - every * share) / np.sqrt(every * share * (1 - share) + 1e-9)
    alone = np.abs(surprise) >= STANDS_OUT
    screen = screen_of(bucket, every, toxic, mark, alone, share)
    chosen = alone | np.isin(screen.place[bucket], pair_terms(sample, screen, units, folder))
    if not chosen.any():
        return Model(float(np.log(true_share / (1 - true_share))), place, np.zeros(1), np.zeros((FACTORS, 1)))
    place[bucket[chosen]] = np.arange(int(chosen.sum()))
    odds = np.log((toxic + share) / (every - toxic + 1 - share) * (1 - share) / share)[chosen]

    def find(w: np.ndarray, v: np.ndarray) -> pa.Table:  # a row for each text of the sample
        return sample.mapInArrow(_most_toxic_terms(place, w, v), "doc_id long, terms array<int>").toArrow()

    return fit(place, odds, ids, weight, y, find)


def scores(model: Model, column: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
    for rows, starts, data in W.chunks(column, TEXT_BYTES):
        words, buckets = terms(starts, data)
        logits = model.logits(cut_windows(words.counts, *known_terms(words.counts, buckets, model.place)))
        yield rows, 1 / (1 + np.exp(-logits))


def scored(docs: DataFrame, model: Model, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, score in scores(model, batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return found.select(
        "doc_id",
        (fold("doc_id", folds) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, score in scores(model, batch.column("text")):
                yield batch[rows].filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
