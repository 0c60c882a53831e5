"""The stages' decisions on the smallest tables."""

import corpus_pipeline
import pytest

from jsonloom.llm import decontamination, mixing, near_dedup, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(outputs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "benchmark", "mix", "shards"]
    for name in names[:-1]:
        assert outputs[name].columns == outputs["documents"].columns


def test_decisions(spark, outputs):
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(outputs["toxicity"]) == ids(toxicity.toxicity_report(outputs["documents"], labels).where("predicted = 0"))
    assert ids(outputs["near_duplicates"]) == ids(near_dedup.near_dedup(outputs["toxicity"]).where("kept"))
    assert set(ids(outputs["benchmark"])) == set(ids(outputs["near_duplicates"])) - set(ids(decontamination.contaminated(outputs["near_duplicates"], benchmark)))
    report = mixing.mix_report(mixing.slim(outputs["benchmark"], 9)).where("size > 0").collect()
    assert ids(outputs["mix"]) == sorted(r.doc_id for r in report for _ in range(r.uses))
    assert ids(outputs["shards"]) == ids(outputs["mix"])


def test_shards_are_even(outputs):
    sizes = {}
    rows = outputs["shards"].selectExpr("shard", "octet_length(text) + 8 as size").collect()
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_run(spark, outputs):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.shard, r.slot, r.doc_id) for r in got.collect()) == sorted((r.shard, r.slot, r.doc_id) for r in outputs["shards"].collect())


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, bit int, document int, matches int, size string"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_tables(spark, tmp_path, name, stage):
    """Nulls, empty texts, ties, repeated rows and columns of names that are used inside: rows stay whole; an empty table stays empty."""
    rest = ("en", "a", 1, "r", 1, 2, 3, "s")
    rows = [(1, "one two three four five six", *rest), (None, "seven eight nine ten", *rest), (2, None, *rest), (3, "", *rest), (None, None, None, None, None, *rest[3:])]
    rows += [(4, "the same words in every row here", *rest)] * 3 + [(5, "the same words in every row here", *rest), (6, "x " * 5000, *rest)]
    spark.createDataFrame(rows, ODD).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = stage(spark, docs, FOLDER)
    assert got.columns[: len(docs.columns)] == docs.columns
    given = {repr(tuple(r)) for r in docs.collect()}
    kept = [r for r in got.select(*docs.columns).collect()]
    assert all(repr(tuple(r)) in given for r in kept)
    if name == "near_duplicates":
        assert sorted(r.doc_id for r in kept if r.text and r.text.startswith("the same")) == [4]
        assert len(kept) == len(rows) - 3
    if name in ("toxicity", "benchmark", "shards"):
        assert len(kept) == len(rows)
    assert stage(spark, docs.where("doc_id = 99"), FOLDER).count() == 0
