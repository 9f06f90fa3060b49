"""Segmented index: ids, replays, merges, readers of old versions, writers that lose."""

import json

import pytest

from quarry.operators import index as ix
from quarry.operators import quality
from quarry.session import scratch_path
from quarry.sources import index_store, segments

BATCHES = [[("d/2", "beta gamma. "), ("d/1", "alpha beta. ")], [("d/1", "alpha again. "), ("d/3", "gamma delta. ")],
           [("c/9", "delta. "), ("c/8", "no words 1")], [("e/1", "tail words end. "), ("d/2", "other text. ")]]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_name string, text string")


def content(index):
    return sorted((r.doc_name, r.word, r.doc_id, tuple(r.positions)) for r in ix.doc_names(index.doc_table, index.postings).collect())


@pytest.fixture
def grown(spark):
    path = scratch_path(spark, "segments")
    for i, rows in enumerate(BATCHES):
        segments.add_batch(docs(spark, rows), path, i)
    return path


def test_ids_continue_and_known_names_stay(spark, grown):
    idx = segments.open_segments(spark, grown)
    ids = {r.doc_name: r.doc_id for r in idx.doc_table.collect()}
    assert ids == {"d/1": 1, "d/2": 2, "d/3": 3, "c/8": 4, "c/9": 5, "e/1": 6}
    words = {(r[0], r[1]) for r in content(idx)}
    assert ("d/1", "again") not in words and ("d/2", "other") not in words and ("e/1", "tail") in words
    assert segments.manifest(spark, grown)["batches"] == [0, 1, 2, 3] and segments.versions(spark, grown) == [1, 2, 3, 4]
    assert set(r.violations for r in quality.check_index(idx, segments.BUCKETS).collect()) == {0}


def test_replay_and_merge_leave_the_same_rows(spark, grown):
    before = content(segments.open_segments(spark, grown))
    old = segments.open_segments(spark, grown, 2)
    was = content(old)
    assert segments.add_batch(docs(spark, BATCHES[1]), grown, 1)["version"] == 4
    merged = segments.merge_small(spark, grown, 2)
    assert merged["version"] == 5 and len(merged["segments"]) == 1
    idx = segments.open_segments(spark, grown)
    assert content(idx) == before and content(old) == was
    hits = index_store.lookup_words(idx, spark.createDataFrame([("beta",), ("delta",)], "word string"))
    assert sorted(r.doc_id for r in hits.collect()) == [1, 2, 3, 5]
    assert segments.merge_small(spark, grown, 2)["version"] == 5          # nothing small is left to merge
    gone = segments.remove_unused(spark, grown)
    assert len(gone) == 4 and segments.versions(spark, grown) == [5]
    assert content(segments.open_segments(spark, grown)) == before
    assert segments.add_batch(docs(spark, [("z/1", "last one. ")]), grown, 4)["version"] == 6
    assert max(r.doc_id for r in segments.open_segments(spark, grown).doc_table.collect()) == 7


def test_empty_batches_and_indices(spark):
    path = scratch_path(spark, "segments")
    assert segments.open_segments(spark, path).postings.count() == 0
    made = segments.add_batch(docs(spark, []), path, 0)
    assert made["segments"] == [] and made["batches"] == [0]
    with pytest.raises(ValueError):
        segments.open_segments(spark, path, 7)


def test_a_writer_that_lost_the_race_fails_and_changes_nothing(spark, grown, monkeypatch):
    before, stale = content(segments.open_segments(spark, grown)), segments.manifest(spark, grown, 3)
    real = segments.manifest
    monkeypatch.setattr(segments, "manifest", lambda s, p, v=None: json.loads(json.dumps(stale)) if v is None else real(s, p, v))
    with pytest.raises(RuntimeError, match="another writer"):
        segments.add_batch(docs(spark, [("q/1", "lost words. ")]), grown, 9)
    monkeypatch.undo()
    assert content(segments.open_segments(spark, grown)) == before and segments.versions(spark, grown)[-1] == 4
