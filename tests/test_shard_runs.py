"""A5 + J1: a sharded run that is broken off and started again gives the corpus of an unbroken one."""

import json

import pytest

from textmill.operators import dedup as dd
from textmill.plans.jobs import process_shards


def write_shards(folder):
    folder.mkdir()
    for n in range(4):
        rows = [{"text": f"Some clean words of document {k % 23} in a line of text.", "meta": {"pile_set_name": "Pile-CC"}} for k in range(n * 10, n * 10 + 10)]
        (folder / f"part {n}.jsonl").write_text("\n".join(map(json.dumps, rows)))


def corpus(spark, out):
    rows = spark.read.schema("subset string, text string, hash string").option("basePath", f"{out}/corpus").json(f"{out}/corpus/*")
    return sorted((r.shard, r.text, r.hash) for r in rows.selectExpr("*", "regexp_extract(input_file_name(), 'shard=([^/]*)', 1) AS shard").collect())


def test_restart_gives_the_same_corpus(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    write_shards(source)
    whole = str(tmp_path / "whole")
    got = process_shards(spark, str(source), whole, normalize=False)
    assert list(got) == [f"part {n}" for n in range(4)] and sum(got.values()) == 23
    want = corpus(spark, whole)
    broken = str(tmp_path / "broken")
    own, calls = dd._exists, []

    def fails_late(spark, path):  # the third shard is broken off after the second is done
        calls.append(path)
        if len([c for c in calls if c.endswith("hashes")]) > 2:
            raise KeyboardInterrupt
        return own(spark, path)

    monkeypatch.setattr(dd, "_exists", fails_late)
    with pytest.raises(KeyboardInterrupt):
        process_shards(spark, str(source), broken, normalize=False)
    monkeypatch.setattr(dd, "_exists", own)
    # A shard that wrote its corpus and hashes but is not marked as done is written anew.
    spark.createDataFrame([("x",)], "hash string").write.parquet(f"{broken}/hashes/shard=part%202")
    again = process_shards(spark, str(source), broken, normalize=False)
    assert list(again) == ["part 2", "part 3"]
    assert corpus(spark, broken) == want
    assert process_shards(spark, str(source), broken, normalize=False) == {}
    assert spark.read.parquet(f"{broken}/done").count() == 4
