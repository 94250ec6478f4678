"""Repeated rows, large and missing ids, few rows, other languages."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from tests.llm import brute, data

from tidemark.llm import mixing, privacy, queries, rules, shards, weak_labels
from tidemark.llm.frames import staged

# ------------------------------------------------------------------ mixing


@pytest.mark.parametrize("ids, kind", [([2**60 + 1, 2**60 + 3, None], "long"), (["a", "b", None], "string")])
def test_mix_keeps_ids(spark, ids, kind):
    rows = [(i, "some words of text", "s") for i in ids]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, source string")
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == Counter(ids)


def test_rates_solve_the_dual(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "a", "b", "c", None])) for i in range(400)]
    found = mixing.mix(data.documents(spark, rows)).collect()
    sizes = defaultdict(list)
    for _, t, s in rows:
        sizes[s].append(len(t.split()))
    targets = brute.water_levels({s: sum(x) for s, x in sizes.items()}, mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    for source, of in sizes.items():
        some = [x for x in of if x]
        mean = sum(of) / len(of)

        def rate(x, lam, mean=mean):
            return math.exp(min(math.log(mixing.MOST), lam * x / mean))

        low, high = -1000.0, 1000.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(x * rate(x, mid) for x in some) < targets[source] else (low, mid)
        rates = {(r["size"], r["rate"]) for r in found if r["source"] == source and r["size"]}
        assert rates and all(got == pytest.approx(rate(x, low), rel=1e-3) for x, got in rates)


# ------------------------------------------------------------------ sharding


def test_shards_of_a_row_repeated_often(spark):
    rows = [(1, "x" * 100, "hot")] * 4000 + [(i, "y" * 100, f"s{i % 50}") for i in range(4000)]
    found = shards.shard(data.documents(spark, rows), 40).collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
        if r["doc_id"] != 1:
            assert r["text_crc32"] == zlib.crc32(b"y" * 100)
    assert len(found) == 8000 and len(sizes) == 40
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 40 + 2 * 116


def test_tree_cuts_the_widest_dimension_at_weighted_medians(spark):
    rng = random.Random(6)
    rows = [(i, "x" * int(rng.paretovariate(0.8) * 20 % 5000), rng.choice("abcdefg")) for i in range(3000)]
    meta = staged(shards.describe(data.documents(spark, rows)), "test")
    tree = shards.grow(meta, 11)
    found = [r.asDict() for r in meta.collect()]
    total = sum(r["size"] for r in found)
    largest = max(r["size"] for r in found)
    keys = [f"k{d}" for d in range(len(shards.DIMENSIONS))]

    def width(of, k):
        return (max(r[k] for r in of) - min(r[k] for r in of)) >> 32

    whole = {k: max(1, width(found, k)) for k in keys}

    def walk(node, of):
        if node.left is None:
            assert node.count == 1
            return 1
        widths = [width(of, k) / whole[k] for k in keys]
        assert widths[node.key] == max(widths)
        left = [r for r in of if r[f"k{node.key}"] < node.cut]
        right = [r for r in of if r[f"k{node.key}"] >= node.cut]
        wanted = sum(r["size"] for r in of) * (node.count // 2) / node.count
        assert abs(sum(r["size"] for r in left) - wanted) <= largest + 2 * shards.FINE * total
        return walk(node.left, left) + walk(node.right, right)

    assert walk(tree, found) == 11


# ------------------------------------------------------------------ weak labels


def test_repeated_rows_train_once(spark, monkeypatch):
    monkeypatch.setattr(weak_labels, "TRAIN_ROWS", 40)
    rows = [(0, data.sentence(random.Random(0), 60), "a")] * 500
    rows += [(i, data.sentence(random.Random(i), 60), "a") for i in range(1, 200)]
    seen = []
    whole = weak_labels.train
    monkeypatch.setattr(weak_labels, "train", lambda labelled: seen.append(labelled.count()) or whole(labelled))
    found = weak_labels.classify(data.documents(spark, rows)).collect()
    assert seen == [40]
    assert len(found) == 699 and len({r["score"] for r in found if r["doc_id"] == 0}) == 1


# ------------------------------------------------------------------ personal data


def named(others, between=""):
    rows = [(i, f"letter {i} about the weather and other things") for i in range(others)]
    return rows + [(10_000 + i, f"note {i} Zebrowski {between} zeb@clinic.example.org told us") for i in range(5)]


@pytest.mark.parametrize("others, broadcast", [(25, 10**6), (55, 0), (2000, 10**6)])
def test_terms_do_not_depend_on_the_size_of_the_table(spark, monkeypatch, others, broadcast):
    monkeypatch.setattr(privacy, "BROADCAST_TERMS", broadcast)
    docs = spark.createDataFrame(named(others), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in privacy.sanitise(docs).collect()}
    for i in range(5):
        text = dict(named(0))[10_000 + i]
        at = text.index("Zebrowski")
        assert f"removed:{at}:{at + 9}" in found[10_000 + i]
    assert all(found[i] == "" for i in range(others))


def test_terms_of_a_common_entity_need_evidence(spark):
    """An address in a third of the rows is no reason to remove words that stand beside it twice."""
    rows = [(i, f"plain text {i} of many words") for i in range(200)]
    rows += [(300 + i, f"rare{i // 2} word, write to office@site.example.org") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r["spans"] for r in privacy.sanitise(docs).filter("doc_id >= 300").collect()]
    assert not any("rare" in dict(rows)[300 + i][int(a) : int(b)] for i, s in enumerate(found)
                   for _, a, b in (x.split(":") for x in s.split(",") if not x.startswith("email")))


@pytest.mark.parametrize("context, recall", [(64, 0), (200, 1), (None, 1)])
def test_context_bounds_where_terms_are_looked_for(spark, context, recall):
    far = "plain words stand here in a row " * 5
    docs = spark.createDataFrame(named(300, far), "doc_id long, text string")
    found = privacy.sanitise(docs, context=context).filter("doc_id >= 10000").collect()
    hits = sum("removed:7:16" in r["spans"] for r in found)
    assert hits == 5 * recall


def test_query_looks_for_terms_in_whole_texts(spark, tmp_path):
    far = "plain words stand here in a row " * 40
    docs = spark.createDataFrame(named(300, far), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op8_disclosure(spark, str(tmp_path)).filter("doc_id >= 10000").collect()
    assert sum("removed:7:16" in r["spans"] for r in found) == 5


# ------------------------------------------------------------------ quality rules


def test_rules_on_words_judge_known_languages_only(spark):
    russian = " ".join(f"слово{i}" for i in range(400))
    chinese = " ".join("文" * 80 for _ in range(30))
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, x) for t in (russian, chinese) for x in ("ru", None, "en"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(docs, base=[]).collect()}
    assert kept == {0: True, 1: True, 2: False, 3: True, 4: True, 5: False}
    assert rules.judge(docs.drop("lang"), base=[]).filter("kept").count() == 6
