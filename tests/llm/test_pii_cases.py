"""All known cases of personal data reach the trees, however many there are."""

import pytest

from jsonloom.llm import pii


class Seen(Exception):
    pass


def test_trees_are_fitted_on_all_known_cases(spark, tmp_path, monkeypatch):
    texts = [(i, f"write to a{i}@mail{i}.net or ping 999.{i % 256}.1.1 now") for i in range(4000)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    rows = pii.cut_lineage(pii.candidates(pii.numbered(spark.read.parquet(str(tmp_path / "docs")))))
    known = rows.selectExpr("explode(loose) as c").where("c.label is not null")
    held = known.where("pmod(c.chance, 5) = 0").count()
    fitted = []

    class Trees:
        def __init__(self, **settings):
            pass

        def fit(self, frame):
            fitted.append(frame.count())
            raise Seen

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    with pytest.raises(Seen):
        pii.fit(rows, pii.Settings())
    assert known.count() >= 8000 and 0 < held < known.count()
    assert fitted == [known.count() - held]
