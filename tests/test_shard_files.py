"""Metadata and shards are written in several files."""

import os

from conftest import SF_SMALL
from textmill.plans import catalog


def test_metadata_is_many_bounded_arrays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / name))
    want = {tuple(r) for r in catalog.q_book_metadata(spark, SF_SMALL).collect()}
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / f"{name}-many"))
    monkeypatch.setattr(catalog, "METADATA_ITEMS", 10)
    got = [tuple(r) for r in catalog.q_book_metadata(spark, SF_SMALL).collect()]
    assert len(got) == len(set(got)) == len(want) and set(got) == want
    files = [f for f in (tmp_path / "metadata-many").iterdir() if f.name.startswith("part-")]
    assert len(files) > 10 and max(f.read_text().count('"book_name"') for f in files) < 40


def test_shards_have_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "table", lambda s, d, name, t=catalog.table: t(s, d, name).repartition(3))
    assert {r.n_shards for r in catalog.q_shards(spark, SF_SMALL).collect()} == {1}
    assert all(sum(f.endswith(".json") for f in os.listdir(tmp_path / "shards" / f"split{k}")) == 3 for k in range(4))


def test_stream_and_shard_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "FILE_DOCS", 10)
    n = catalog.table(spark, SF_SMALL, "documents").count()
    want = sorted(r.hash for r in catalog.QUERIES["q_process_corpus_nogates"](spark, SF_SMALL).collect())
    assert sorted(r.hash for r in catalog.q_process_shards(spark, SF_SMALL).collect()) == want
    assert sorted(r.hash for r in catalog.q_stream_dedup(spark, SF_SMALL).collect()) == want
    shards = [p for p in (tmp_path / "shard_source").iterdir() if p.is_dir()]
    assert len(shards) == 4 and len(list((tmp_path / "shard_runs" / "corpus").glob("shard=*"))) == 4
    files = [f for p in shards for f in p.glob("part-*.json")]
    assert len(files) >= n // 10 and max(len(f.read_text().splitlines()) for f in files) < 30
    assert len(list((tmp_path / "stream_source").glob("part-*.parquet"))) >= n // 10
