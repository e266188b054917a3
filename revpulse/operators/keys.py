"""Checks of keys and references that move hashes and few texts.

A filter of words is a table of ``word, bits``: a hash picks a key's word, other hashes pick ``PROBES`` of its 64 bits.
A key that was put in is always found again; one that was not is found by chance, with the share of bits that are
set to the power of ``PROBES``. So whatever a filter lets through is looked at again by its text, and results
are exact. A filter has at most ``MOST_WORDS`` rows, whatever goes into it, so it is safe to broadcast.

A filter holds few repeated keys. ``key_pass``, which only counts them, has to do with as many as there are: it knows a
key that should be unique by two hashes of 96 bits together and does not look at its text again. Among a
billion different keys the chance that any two share both is about one in a hundred billion.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions.numeric import count_where, or_zero

PROBES, KEYS_PER_WORD, MOST_WORDS = 3, 6, 1 << 20
#: Words of the filter for keys that are suspected to repeat; in sound tables there are none.
SUSPECT_WORDS = 1 << 14
#: Keys that one task counts, where their number is known; these take some hundred MB.
KEYS_PER_TASK = 1 << 20


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def moved(df: DataFrame) -> DataFrame:
    """A side of a join that is sorted and merged, and never broadcast.

    Spark takes the bytes of files for the size of what it reads from them. Relations that were written out compress many times
    over, so one of any number of rows can pass for small and then take the driver's memory. A side that ends in a
    shuffle, as after a fold, is measured before it is broadcast and needs none of this.
    """
    return df.hint("merge")


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> Column:
    """``PROBES`` bits of a word, from six bits each of a second hash."""
    second = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("bigint")
    bits = F.call_function("shiftleft", one, F.pmod(second, F.lit(64)).cast("int"))
    for k in range(1, PROBES):
        place = F.pmod(F.shiftright(second, 6 * k), F.lit(64)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", one, place))
    return bits


def filter_words(keys: int) -> int:
    """How many words a filter of so many keys has, or 0 if they do not fit one."""
    words = max(1, -(-keys // KEYS_PER_WORD))
    return words if words <= MOST_WORDS else 0


def key_filter(df: DataFrame, key: str | Column, words: int) -> DataFrame:
    """``word, bits`` of all keys of a table; null is no key."""
    column = F.col(key) if isinstance(key, str) else key
    put = df.where(column.isNotNull()).select(_word(column, words).alias("word"), _bits(column).alias("bits"))
    return put.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def probed(df: DataFrame, key: str, filter_: DataFrame, words: int) -> DataFrame:
    """Rows with a ``maybe`` column: false only if their key is not in the filter. Null keys are false."""
    asked = df.withColumn("asked_word", _word(F.col(key), words)).withColumn("asked_bits", _bits(F.col(key)))
    joined = asked.join(F.broadcast(filter_), F.col("asked_word") == F.col("word"), "left")  # at most MOST_WORDS rows
    found = F.coalesce(F.col("bits").bitwiseAND(F.col("asked_bits")) == F.col("asked_bits"), F.lit(False))
    return joined.withColumn("maybe", F.col(key).isNotNull() & found).drop("asked_word", "asked_bits", "word", "bits")


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``hash, key_rows`` of every hash of a key; a null key has a null hash."""
    return df.groupBy(F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("hash")).agg(F.count(F.lit(1)).alias("key_rows"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``key, key_rows`` of the key values on more than one row; null is not among them.

    First the hashes are counted, which moves two numbers a key. Only rows whose hash may repeat are counted by
    their text. So a key that occurs once never moves as a text, and two keys of one hash are told apart.
    """
    suspects = key_counts(df.select(key), key).where("hash is not null and key_rows > 1").select(F.col("hash").alias("suspect"))
    hashed = df.select(key).withColumn("own_hash", F.when(F.col(key).isNotNull(), F.xxhash64(key)))
    near = probed(hashed, "own_hash", key_filter(suspects, "suspect", SUSPECT_WORDS), SUSPECT_WORDS).where("maybe")
    return near.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 1")


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """The one row ``key, key_rows`` of a null key on more than one row."""
    n = count_where(F.col(key).isNull())
    return df.agg(n.alias("key_rows")).where("key_rows > 1").select(F.lit(None).cast(df.schema[key].dataType).alias(key), "key_rows")


def lost_references(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, parents: int | None = None) -> DataFrame:
    """``orphan_key, child_rows`` of the child keys without a parent; null keys pass.

    Child rows are folded to one for each key before they move, so a key that holds a third of them is one row of
    each task. ``parents`` is the number of parent rows if it is known: if a filter of that many keys fits, keys that
    it does not have are orphans at once, and only the others meet the parent's texts.
    """
    rows = child.select(child_key).where(F.col(child_key).isNotNull())
    keys = rows.groupBy(F.col(child_key).alias("orphan_key")).agg(F.count(F.lit(1)).alias("child_rows"))
    return _without(keys, ["orphan_key"], parent.select(F.col(parent_key).alias("orphan_key")), parents)


def _without(keys: DataFrame, on: list[str], known: DataFrame, parents: int | None) -> DataFrame:
    """Rows of ``keys`` whose columns ``on`` are not in ``known``."""
    words = filter_words(parents) if parents is not None else 0
    if not words:
        return keys.join(moved(known), on, "left_anti")
    whole = F.struct(*on)
    asked = probed(keys.withColumn("whole", whole), "whole", key_filter(known.where(F.col(on[-1]).isNotNull()), whole, words), words).drop("whole")
    sure = asked.where(~F.col("maybe"))
    return sure.union(asked.where("maybe").join(moved(known), on, "left_anti").select(sure.columns)).drop("maybe")


class Unique(NamedTuple):
    relation: str
    column: str


class Reference(NamedTuple):
    relation: str
    column: str
    parent: str
    parent_column: str


def key_pass(
    relations: Mapping[str, DataFrame],
    uniques: Sequence[Unique],
    references: Sequence[Reference],
    parents: int | None = None,
    keys: int | None = None,
) -> DataFrame:
    """``check, failed_rows`` of many checks at once: values that repeat, and rows whose key has no parent.

    ``check`` numbers the uniques and then the references; null keys pass. Two shuffles count the keys of all
    relations: those that should be unique move as two hashes, those that refer to others, which
    fold to few, as texts. Parents' keys meet the folded texts, by the relation they belong to. However many keys
    repeat, none is read or moved a second time.

    ``keys`` is about how many there are of the first kind, if that is known. They are then dealt to as many tasks as they
    call for and counted there: keys that are nearly all different fold nothing before they move, and no task
    holds more than its share. Copies of one key go to one task, as one number each for it to count.
    """
    first = len(uniques)
    if not uniques and not references:
        raise ValueError("no keys to check")
    parts = []
    if uniques:
        hashed = _every(relations, uniques, 0, lambda column: (F.xxhash64(column).alias("hash"), F.hash(column).alias("other")))
        if keys is not None:
            hashed = hashed.repartition(max(1, math.ceil(keys / KEYS_PER_TASK)), "hash")
        repeated = hashed.groupBy("check", "hash", "other").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(repeated.groupBy("check").agg(F.count(F.lit(1)).alias("failed_rows")))
    if references:
        homes = list(dict.fromkeys((r.parent, r.parent_column) for r in references))
        known = union_all(
            relations[name].select(F.lit(k).alias("home"), F.col(column).cast("string").alias("text")) for k, (name, column) in enumerate(homes)
        )
        home = F.element_at(F.array(*(F.lit(homes.index((r.parent, r.parent_column))) for r in references)), F.col("check") - first + 1)
        folded = _every(relations, references, first, lambda column: (column.alias("text"),)).groupBy("check", "text").agg(F.count(F.lit(1)).alias("n"))
        asked = folded.select("check", home.alias("home"), "text", "n")
        parts.append(_without(asked, ["home", "text"], known, parents).groupBy("check").agg(F.sum("n").alias("failed_rows")))
    # Checks without a failing row are in the result as well; a row for each check.
    named = parts[0].sparkSession.range(first + len(references)).select(F.col("id").cast("int").alias("check"))
    return named.join(F.broadcast(union_all(parts)), "check", "left").select("check", or_zero(F.col("failed_rows")).alias("failed_rows"))


def _every(
    relations: Mapping[str, DataFrame], checks: Sequence[Unique | Reference], first: int, parts: Callable[[Column], tuple[Column, ...]]
) -> DataFrame:
    """``check`` and ``parts`` of the text of every key that is not null, each relation read once; numbers begin at ``first``."""
    of: dict[str, list[Column]] = {}
    for k, c in enumerate(checks, first):
        text = F.col(c.column).cast("string")
        of.setdefault(c.relation, []).append(F.when(text.isNotNull(), F.struct(F.lit(k).alias("check"), *parts(text))))
    rows = (relations[name].select(F.explode(F.array(*asked)).alias("row")) for name, asked in of.items())
    return union_all(rows).where(F.col("row").isNotNull()).select("row.*")
