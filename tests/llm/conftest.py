import pytest

from tickframe.llm._common import let_workers_import

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def workers(spark):
    let_workers_import(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(workers):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        df = workers.createDataFrame(full, DOCUMENT)
        return df.selectExpr("*", extra) if extra else df

    return make


@pytest.fixture
def collected(workers, monkeypatch):
    """Lengths of the texts in all rows that reach the driver."""
    kind, sizes = type(workers.range(0)), []

    def collect(df, plain=kind.collect):
        rows = plain(df)
        sizes.extend(len(r["text"] or "") for r in rows if "text" in r.asDict())
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    return sizes
