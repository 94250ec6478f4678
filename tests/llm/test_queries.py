"""The queries against their SQL, and the pipeline stage by stage, on the smallest tables."""

from collections import Counter

import duckdb
import pytest
from tests.llm import brute, data

import corpus_pipeline
from check import canonical
from tidemark.llm import mixing, queries, rules
from tidemark.llm.frames import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_returns_all_rows(spark, name):
    of = "conversations" if name.startswith("op6") else "documents"
    assert queries.QUERIES[name](spark, SF).count() == table(spark, SF, of).count()


def test_pipeline(spark):
    before = table(spark, SF, "documents")
    columns = before.columns
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = staged(stage(spark, before, SF), "test")
        old = {r["doc_id"]: r for r in before.collect()}
        new = Counter(r["doc_id"] for r in after.collect())
        if at < 4:
            assert after.columns == columns
        if at == 0:
            assert set(new) == {r["doc_id"] for r in rules.judge(before).filter("kept").collect()}
        if at == 1:
            groups = brute.near_duplicates([(d, r["text"]) for d, r in old.items()], 5, 80)
            assert new == Counter({c for _, _, c in groups})
        if at == 2:
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            hit = {r[0] for r in brute.contaminated([(d, r["text"]) for d, r in old.items()], items) if r[-1]}
            assert hit and new == Counter(set(old) - hit)
        if at == 3:
            taken = Counter()
            for d, n in new.items():
                assert n <= mixing.MOST
                taken[old[d]["source"]] += n * len(brute.WORD.findall(old[d]["text"]))
            sizes = Counter()
            for r in old.values():
                sizes[r["source"]] += len(brute.WORD.findall(r["text"]))
            for s, t in brute.water_levels(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST).items():
                assert taken[s] == pytest.approx(t, rel=0.1)
        if at == 4:
            assert new == Counter(r["doc_id"] for r in before.collect())
        before = after


@pytest.mark.parametrize("rows", [[], data.edge_rows()])
def test_stages_on_awkward_rows(spark, rows):
    """Each stage by itself, on rows with NULLs, copies and columns named like its own."""
    docs = data.documents(spark, rows)
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF)
        if at < 4:
            assert after.columns == docs.columns, name
        found = Counter((r["doc_id"], r["text"]) for r in after.collect()) if at < 4 else None
        given = Counter((d, t) for d, t, _ in rows)
        if at in (0, 2):
            assert all(n == given[k] for k, n in found.items())
        if at == 1:
            assert set(found.values()) <= {1, *[n for k, n in given.items() if not (k[1] or "").split()]}
            assert sum(not (t or "").split() for _, t in found.elements()) == sum(
                not (t or "").split() for _, t in given.elements()
            )
        if at == 4:
            assert after.count() == len(rows)
