"""The registered queries against their SQL, and what any of them has to stand."""

import duckdb
import pytest

import __spark_entry__ as entry
from tallyframe.llm.registry import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
HARD = [
    (1, "the quick brown fox jumps over the lazy dog today and then some more", "en", "a", 1),
    (1, "the quick brown fox jumps over the lazy dog today and then some more", "en", "a", 1),
    (2, None, None, None, None),
    (None, "", "en", "b", 0),
    (None, "password = hunter2hunter2 mail a.b@c.de +49 170 1234567 4111 1111 1111 1111", "en", None, 5),
    (5, "word " * 40_000, "en", "a", 9),
    (6, "é́ ſ 中文 \t\x0b mixed\r\nlines", "fr", "ü", 3),
    (7, "x" * 300_000, "en", "b", 3),
    (8, "12.34.56.78 and 300.1.1.1 or 1.1.1.1.1.1.1.1 " * 3, "en", "b", 3),
    (9, "9" * 100_000, "en", "c", 3),
]
TALK = [
    *[(1, t, r, x) for t, r, x in [(0, "system", "Be kind."), (1, "user", "Why?"), (1, "user", "Why?"), (2, "assistant", None), (None, "user", "no turn"), (9, None, "who"), (5, "", "none.")]],
    *[(2, t, "user", "again.") for t in range(40)],
    *[(3, t, ["user", "assistant"][t % 2], f"number {t}" + "." * (t % 3)) for t in range(60)],
    *[(None, t % 5, "assistant", f"é{t}! \t") for t in range(12)],
    (4, None, None, None),
    (5, 7, "user", "x" * 200_000 + "?"),
    (6, -5, "umpire", "..."),
    (6, 2**40, "System", "\x0b"),
]


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = database.execute(oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    result = entry.queries()[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, result.select(*columns).collect()))) == sorted(map(repr, expected.fetchall()))


@pytest.fixture
def hard(make, tmp_path):
    """Tables with nulls, empty and very long texts, ties, repeated rows, and columns of clashing names."""
    docs = make("doc_id:long text:string lang:string source:string n_chars:long", HARD)
    names = ["row", "hash", "size", "id", "n", "label", "spans", "key"]
    docs.selectExpr("*", *[f"'{n}' as {n}" for n in names]).write.parquet(f"{tmp_path}/hard/documents.parquet")
    make("item_id:long text:string", [(1, "lazy dog"), (2, None), (None, "brown fox jumps"), (3, "..."), (1, "lazy dog")]).write.parquet(f"{tmp_path}/hard/benchmark.parquet")
    make("doc_id:long quality:int toxic:int", [(1, 1, 1), (1, None, 0), (2, 0, None), (None, 1, 1), (7, 1, 0)]).write.parquet(f"{tmp_path}/hard/labels.parquet")
    page = "<p>" + "same " * 40
    make("page_id:long url:string html:string", [(3, "u", page), (2, None, page), (2, None, page), (None, "v\r\nw", page), (4, "x", "a"), (5, "y", "a"), (6, "z", None)]).write.parquet(f"{tmp_path}/hard/pages.parquet")
    rows = [(i, [float(i % 7), 1.0, -1.0]) for i in range(300)] + [(300, None), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 2.0]), (600, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    labelled = [(i, v, None if j % 3 == 0 else j % 2) for j, (i, v) in enumerate(rows)]
    vectors = make("vec_id:long embedding:vector label:int", labelled)
    vectors.selectExpr("*", *[f"'{n}' as {n}" for n in ["row", "code", "whole", "error", "of"]]).write.parquet(f"{tmp_path}/hard/embeddings.parquet")
    talk = make("conv_id:long turn:long role:string text:string", TALK)
    talk.selectExpr("*", *[f"'{n}' as {n}" for n in ["conv", "phase", "n", "digest", "kind"]]).write.parquet(f"{tmp_path}/hard/conversations.parquet")
    return f"{tmp_path}/hard"


@pytest.mark.parametrize("name", list(queries()))
def test_hard_tables(spark, hard, name):
    result = queries()[name](spark, hard).collect()
    if name in oracle_sql():
        database = duckdb.connect()
        for table in TABLES:
            database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{hard}/{table}.parquet/*.parquet'")
        expected = database.execute(oracle_sql()[name])
        columns = [d[0] for d in expected.description]
        assert sorted(repr(tuple(r[c] for c in columns)) for r in result) == sorted(map(repr, expected.fetchall()))
    elif name not in ("pipeline", "op7_nearest_vectors"):
        assert sorted(r["doc_id"] or 0 for r in result) == sorted(d[0] or 0 for d in HARD)


@pytest.mark.parametrize("name", list(queries()))
def test_empty_tables(spark, hard, tmp_path, name):
    for table in TABLES:
        spark.read.parquet(f"{hard}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/empty/{table}.parquet")
    assert queries()[name](spark, f"{tmp_path}/empty").collect() == []
