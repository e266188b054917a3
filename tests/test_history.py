"""Commits where renames are not atomic, and logs that stay in few files."""

import random
import threading

import pytest

from revpulse.operators import monitoring
from revpulse.plans.build import RunLog
from revpulse.sources.history import History
from revpulse.sources.manifest import KEPT, CreateStore, Manifest


class ObjectStore:
    """Texts that appear whole, cannot be renamed, and are put only if they are absent; calls take turns at random."""

    def __init__(self, seed):
        self.texts, self.rng, self.lock, self.refused = {}, random.Random(seed), threading.Lock(), 0

    def _wait(self):
        threading.Event().wait(self.rng.random() * 0.002)

    def names(self):
        self._wait()
        return list(self.texts)

    def read(self, name):
        self._wait()
        return self.texts.get(name)

    def put_if_absent(self, name, text):
        self._wait()
        with self.lock:
            if name in self.texts:
                self.refused += 1
                return False
            self.texts[name] = text
            return True

    def delete(self, name):
        self.texts.pop(name, None)


def test_commits_on_an_object_store_lose_nothing():
    store = ObjectStore(1)

    def work(who):
        manifest = Manifest(None, "s3a://somewhere/warehouse", store)
        for k in range(15):
            manifest.commit(lambda was: {**was, f"{who}-{k}": k})

    threads = [threading.Thread(target=work, args=(who,)) for who in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(Manifest(None, "s3a://somewhere/warehouse", store).read()) == 90 and store.refused > 0
    assert len(store.texts) <= KEPT + 6


def test_a_reader_that_is_overtaken_reads_again():
    store = ObjectStore(2)
    manifest = Manifest(None, "x", store)
    manifest.commit(lambda was: {"k": 0})
    names, first = store.names, True

    def overtaken():
        nonlocal first
        found = names()
        if first:
            first = False
            for k in range(1, KEPT + 3):
                manifest.commit(lambda was: {"k": k})
        return found

    store.names = overtaken
    assert manifest.read() == {"k": KEPT + 2}


def test_creating_a_file_that_is_there_fails(spark, tmp_path):
    store = CreateStore(spark, str(tmp_path))
    assert store.put_if_absent("000000000001.json", "{}") and not store.put_if_absent("000000000001.json", '{"a": 1}')
    assert store.read("000000000001.json") == "{}" and store.read("000000000002.json") is None
    one, other = (Manifest(spark, str(tmp_path), CreateStore(spark, f"{tmp_path}/m")) for _ in range(2))
    one.commit(lambda was: {**was, "a": 1})
    other.commit(lambda was: {**was, "b": 2})
    assert one.read() == {"a": 1, "b": 2}


def test_many_appends_leave_few_files(spark, tmp_path):
    """A thousand would take minutes; with a smaller fanout fewer appends reach as many levels."""
    log = History(spark, str(tmp_path), "k int, v string", fanout=3)
    assert log.read().count() == 0
    for k in range(40):
        log.append(spark.createDataFrame([(k, str(k))], "k int, v string"))
        if k % 13 == 0:
            assert sorted(r.k for r in log.read().collect()) == list(range(k + 1))
    assert sorted(r.k for r in log.read().collect()) == list(range(40))
    levels = [level for _, level in log.parts()]
    assert max(levels) >= 2 and all(levels.count(k) <= 3 for k in set(levels))
    folders = [p for p in tmp_path.iterdir() if p.name.startswith("part=")]
    assert len(folders) <= len(levels) + 4  # and those merged last


def test_two_that_merge_at_once_keep_every_row(spark, tmp_path):
    one, other = (History(spark, str(tmp_path), "k int", fanout=2) for _ in range(2))
    for k in range(2):
        one.append(spark.createDataFrame([(k,)], "k int"))
    real, done = one._write, []

    def slow(rows):
        path = real(rows)
        if len(done) == 0 and rows.count() > 1:
            done.append(1)
            other.compact()
        return path

    one._write = slow
    one.append(spark.createDataFrame([(2,)], "k int"))
    assert done and sorted(r.k for r in other.read().collect()) == [0, 1, 2]


def test_a_run_log_has_equal_answers_after_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("revpulse.sources.history.History.__init__.__defaults__", (2,))
    for k in range(4):
        log = RunLog(spark, f"{tmp_path}/log", f"run-{k}")
        with log.run():
            with log.stage("load"):
                pass
            if k == 3:
                with pytest.raises(RuntimeError), log.stage("check"):
                    raise ValueError("broken")
    runs = {r.run_id: r.status for r in monitoring.run_audit(log.read()).collect()}
    assert runs == {f"run-{k}": "success" for k in range(4)}
    stages = sorted((r.run_id, r.stage_name, r.status) for r in monitoring.stage_audit(log.read()).collect())
    assert stages == [("run-0", "load", "success"), ("run-1", "load", "success"), ("run-2", "load", "success"), ("run-3", "check", "failed"), ("run-3", "load", "success")]
