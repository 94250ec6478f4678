"""Each operator against brute force, on awkward rows and with tiny limits."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm import brute, data

from tidemark.llm import (
    chat,
    links,
    mixing,
    ngram_join,
    privacy,
    rules,
    shards,
    substrings,
    warc,
    weak_labels,
    winnowing,
)


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def edge(spark):
    return data.documents(spark, data.edge_rows())


@pytest.fixture(scope="module")
def nothing(spark):
    return data.documents(spark, [])


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------------ n-gram Jaccard join


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (1, 50)])
def test_near_duplicates_of_awkward_rows(spark, edge, k, percent):
    known = edge.filter("doc_id IS NOT NULL")
    found = ngram_join.near_duplicates(known, ngram_join.Spec(k, percent))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == Counter(
        brute.near_duplicates(pairs_of(known), k, percent)
    )


@pytest.mark.parametrize("part, open_pairs", [(1 << 21, 4), (700, 4), (1 << 21, 0)])
def test_near_duplicates_in_large_groups(spark, monkeypatch, part, open_pairs):
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", part)
    monkeypatch.setattr(ngram_join, "OPEN_PAIRS", open_pairs)
    monkeypatch.setattr(ngram_join, "FIRST_BLOCKS", 1)
    monkeypatch.setattr(ngram_join, "DEALT_SEEN", 10)
    monkeypatch.setattr(ngram_join, "SHARED", 2)
    monkeypatch.setattr(ngram_join, "FANOUT", 2)
    monkeypatch.setattr(ngram_join, "HOT_SEEN", 2)
    monkeypatch.setattr(ngram_join, "HOT_CLASSES", 2)
    texts = data.near_copies(part, groups=3, copies=40, words=120)
    docs = data.documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = ngram_join.near_duplicates(docs)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == Counter(
        brute.near_duplicates(list(enumerate(texts)))
    )


def test_parts_meet_when_the_first_round_links_nothing(spark, monkeypatch):
    """With parts of two and no shared members, links cross parts in the last round."""
    monkeypatch.setattr(ngram_join, "PART_SHINGLES", 300)
    monkeypatch.setattr(ngram_join, "SHARED", 1 << 30)
    texts = data.near_copies(11, groups=2, copies=25, words=150)
    docs = data.documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    assert rows_of(ngram_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == Counter(
        brute.near_duplicates(list(enumerate(texts)))
    )


def test_first_of_a_group_and_null_ids(spark, edge):
    found = ngram_join.near_duplicates(edge)
    assert found.count() == edge.count()
    first = found.filter("is_first AND n_shingles > 0").groupBy("component_id", "doc_id", "key").count()
    assert first.filter("component_id IS NOT NULL AND doc_id IS DISTINCT FROM component_id").isEmpty()


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    found = dict(links.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}


def test_no_documents(spark, nothing):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for found in (
        ngram_join.near_duplicates(nothing),
        substrings.dedup_substrings(nothing),
        winnowing.contamination(nothing, benchmark),
        rules.judge(nothing),
        mixing.mix(nothing),
        shards.shard(nothing),
        privacy.sanitise(nothing),
        weak_labels.classify(nothing),
        warc.histories(pages),
        chat.repair_roles(talks),
    ):
        assert found.count() == 0


# ------------------------------------------------------------------ substring deduplication


@pytest.mark.parametrize("texts", [2000, 1])
def test_removed_substrings(spark, edge, monkeypatch, texts):
    monkeypatch.setattr(substrings, "ANCHOR_TEXTS", texts)
    monkeypatch.setattr(substrings, "HOT_CLASSES", 1)
    found = substrings.dedup_substrings(edge)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.removed(pairs_of(edge)))


@pytest.mark.parametrize("texts", [2000, 3])
def test_removed_substrings_of_near_copies(spark, monkeypatch, texts):
    monkeypatch.setattr(substrings, "ANCHOR_TEXTS", texts)
    rng = random.Random(1)
    few = [f"v{i}" for i in range(3)]
    rows = list(enumerate(data.near_copies(2) + [" ".join(rng.choice(few) for _ in range(60)) for _ in range(20)]))
    docs = data.documents(spark, [(d, t, "s") for d, t in rows])
    found = substrings.dedup_substrings(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.removed(rows))


@pytest.mark.parametrize("texts", [2000, 1])
def test_removed_substrings_of_equal_ids(spark, monkeypatch, texts):
    monkeypatch.setattr(substrings, "ANCHOR_TEXTS", texts)
    passage = " ".join(f"p{i}" for i in range(20))
    around = [" ".join(f"{side}{i}" for i in range(12)) for side in "xy"]
    longer = f"{around[0]} {passage} {around[1]}"
    rows = [(3, passage)]
    rows += [(d, f"{longer} end{d}{i}") for d in (None, 7) for i in range(4)]
    docs = data.documents(spark, [(d, t, "s") for d, t in rows])
    found = substrings.dedup_substrings(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.removed(rows))
    rows = [r for r in rows if r[0] != 7]
    docs = data.documents(spark, [(d, t, "s") for d, t in rows])
    found = substrings.dedup_substrings(docs)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.removed(rows))


def test_texts_of_one_id_meet_their_own_lists_only(spark):
    rows = [(d, f"text {i} of some words", "s") for d in (None, 7) for i in range(6)]
    docs = data.documents(spark, rows + rows)
    described = docs.select("doc_id", "text").mapInArrow(
        substrings._describe, "doc_id bigint, n_words bigint, class bigint, digest string"
    )
    key = F.coalesce("doc_id", F.lit(substrings.NO_ID)).alias("id")
    wanted = described.select(key, "class").distinct()
    found = substrings._texts_of(docs.select(key, "text"), wanted)
    pairs = Counter((r["id"], r["class"], r["text"]) for r in found.collect())
    assert len(pairs) == len(rows)
    assert sum(pairs.values()) <= 2 * len(rows)


def test_suffix_automaton():
    rng = random.Random(0)
    for _ in range(200):
        added = [[rng.choice("ab") for _ in range(rng.randrange(0, 12))] for _ in range(3)]
        asked = [rng.choice("ab") for _ in range(15)]
        automaton = substrings.SuffixAutomaton()
        for x in added:
            automaton.add(x)
        covered = set()
        for a, b in automaton.spans(asked, 4):
            covered.update(range(a, b))
        parts = {tuple(x[i : i + 4]) for x in added for i in range(len(x) - 3)}
        expected = {i + j for i in range(12) if tuple(asked[i : i + 4]) in parts for j in range(4)}
        assert covered == expected


# ------------------------------------------------------------------ benchmark decontamination


@pytest.mark.parametrize("limit", [winnowing.BROADCAST_BYTES, 0])
def test_contamination(spark, edge, monkeypatch, limit):
    monkeypatch.setattr(winnowing, "BROADCAST_BYTES", limit)
    passage = next(t for d, t, _ in data.edge_rows() if d == 7)
    words = passage.split()
    items = [
        (1, passage), (2, " ".join(words[3:13])), (3, " ".join(words[3:12])), (4, "ONE"), (5, None), (6, ""), (7, "!!"),
        (2, " ".join(words[3:13])), (None, " ".join(words[10:21])), (8, "w1 w2 w1 w2 w1 w2 w1 w2 w1 w2 w1"),
        (9, "absent words in this item of the benchmark that occur nowhere else"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = winnowing.contamination(edge, benchmark)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert rows_of(found, *columns) == Counter(brute.contaminated(pairs_of(edge), items))


# ------------------------------------------------------------------ quality rules


def test_rules(spark, edge):
    found = {(r["doc_id"], r["text"]): r for r in rules.judge(edge).collect()}
    for doc, text in pairs_of(edge):
        r, expected = found[doc, text], brute.measured(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r["base_failed"] and r["kept"])
    kept = rules.keep_good(edge)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r["kept"] for r in rules.judge(edge).collect())
    assert {r["kept"] for r in kept.collect()} == {"kept"}


# ------------------------------------------------------------------ mixing


def test_mix(spark, edge):
    rows = mixing.mix(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in pairs_of(edge))
    sizes = Counter()
    for _, t, s in data.edge_rows():
        sizes[s] += len(brute.WORD.findall(t or ""))
    targets = brute.water_levels(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST)
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
    again = Counter((r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(edge).collect())
    assert again == Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)


@pytest.mark.parametrize("chunk", [2000, 50])
def test_mix_comes_near_its_targets(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", chunk)
    rng = random.Random(7)
    rows = [(i, "w " * rng.choice([1, 5, 40, 300, 2000]), rng.choice("aaabcd")) for i in range(1500)]
    docs = data.documents(spark, rows)
    for r in mixing.mix(docs).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect():
        assert r["t"] == pytest.approx(r["target"], rel=0.02)
    copies = mixing.take_copies(docs)
    assert copies.columns == docs.columns
    assert copies.groupBy("doc_id").count().filter("count > 2").isEmpty()
    sizes = {r["source"]: r["target"] for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    for r in copies.groupBy("source").agg(F.sum((F.length("text") / 2)).alias("t")).collect():
        assert r["t"] == pytest.approx(sizes[r["source"]], rel=0.02)


@pytest.mark.parametrize("texts", [1, 300])
def test_mix_deals_rows_of_one_id_and_size(spark, monkeypatch, tmp_path, texts):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 50)
    whole, seen = mixing._round_chunk, str(tmp_path)

    def noted(frame):
        from uuid import uuid4

        with open(f"{seen}/{uuid4()}", "w") as f:
            f.write(str(len(frame)))
        return whole(frame)

    monkeypatch.setattr(mixing, "_round_chunk", noted)
    docs = data.documents(spark, [(None, f"some words {i % texts}", "s") for i in range(300)])
    assert mixing.mix(docs).count() == 300
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sizes and max(sizes) <= 100


# ------------------------------------------------------------------ sharding


def test_shards(spark, edge, monkeypatch):
    monkeypatch.setattr(shards, "SLOT_ROWS", 3)
    rows = shards.shard(edge, 4).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 16) for d, t in pairs_of(edge)
    )
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["shard"] for r in rows} <= set(range(4))


def test_shards_get_equal_bytes(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([10, 100, 1000]), "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    found = shards.shard(data.documents(spark, rows), 7).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    sizes = [r["s"] for r in found]
    assert len(sizes) == 7
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 7 + 2 * 1016


# ------------------------------------------------------------------ personal data


def test_base_spans(spark, edge):
    odd = [
        (101, "a@b.c_d@e.f.g..h@i.j 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.01 +12 x@y.z+1.2 x@q.w"),
        (102, "4111-1111-1111-1111 5 41111111111111111111111111 6011 0000 0000 0004, +49 (30) 12.34-567"),
        (103, "x@" + ".".join("a" * 20_000)),
        (104, " ".join("7" * 20_000) + "a" * 100_000 + "@"),
        (105, "+1" + " " * 20_000 + "+2" + "." * 500 + "3 ñ日本 q@r.st 𝒳 t@u.vw"),
    ]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    found = privacy.sanitise(docs, render=True).collect()
    assert len(found) == docs.count()
    texts = Counter()
    for r in found:
        texts[r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] += 1
    expected = Counter()
    for doc, text in pairs_of(docs):
        spans = brute.personal(text)
        kinds = Counter(k for k, _, _ in spans)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[doc, brute.sha(written), *(kinds[k] for k in brute.KINDS)] += 1
    assert texts == expected
    thirteen = next(r for r in found if r["doc_id"] == 13)
    assert thirteen["sanitised"].endswith("[PHONE] [EMAIL] [IP], [CARD]")


def test_telling_terms(spark):
    filler = "quite common words stand here with many others around them "
    rows = [(i, f"{filler} Reachable: {filler}") for i in range(200)]
    rows += [(300 + i, f"note {i} Doctor Zebrowski writes from zeb@clinic.example.org today {filler}") for i in range(3)]
    rows += [(400, "one@other.example.org with common words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in privacy.sanitise(docs, render=True).collect()}
    for i in range(3):
        assert "removed" in found[300 + i]["spans"]
        assert "Zebrowski" not in found[300 + i]["sanitised"]
        assert "common words" in found[300 + i]["sanitised"]
        assert found[300 + i]["spans"].startswith("email:")
    assert all(found[i]["spans"] == "" and found[i]["sanitised"] is None for i in range(200))
    assert found[400]["spans"].count(":") == 2


def _occurrences(text, term):
    return [(i, i + len(term)) for i in range(len(text)) if text.startswith(term, i)]


def _terms_at(row):
    found = [x.split(":") for x in row["spans"].split(",") if x]
    return sorted((int(a), int(b)) for k, a, b in found if k in privacy.ACTIONS)


def test_telling_terms_far_from_their_entity(spark):
    far = "quite common words stand here with many others around them " * 4
    rows = [(i, far) for i in range(200)]
    # Near and again far; in most texts only far; a mail address that holds the name itself.
    rows += [(300 + i, f"Zebrowski {i} {far} Zebrowski zebrowski@clinic.example.org {far} Zebrowski") for i in range(2)]
    rows += [(310 + i, f"Zebrowski {i} {far} zebrowski@clinic.example.org") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {r["doc_id"]: r for r in privacy.sanitise(docs, render=True).collect()}
    for i in [300, 301, *range(310, 314)]:
        assert _terms_at(found[i]) == _occurrences(texts[i], "Zebrowski")
        assert "ebrowski" not in found[i]["sanitised"]
        assert "clinic" not in found[i]["sanitised"]
        assert "common words" in found[i]["sanitised"]
    assert all(found[i]["spans"] == "" for i in range(200))


def test_telling_terms_of_any_length_beside_other_entities(spark):
    far = "quite common words stand here with many others around them " * 4
    rows = [(i, f"{far} 1 2 3 a b x org") for i in range(200)]
    # Only the last address is in several texts; others and what is no entity stand between.
    rows += [(300 + i, f"{far} Kim Li 金明 zeb77 QX 4711: u{i}@x.org, 1.2.3.999 shared@x.org {far}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {r["doc_id"]: r for r in privacy.sanitise(docs, render=True).collect()}
    for i in range(300, 303):
        expected = [x for term in ("Kim", "Li", "金明", "zeb77", "QX", "4711", "999") for x in _occurrences(texts[i], term)]
        assert _terms_at(found[i]) == sorted(expected)
        assert "[EMAIL], 1.2.3. [EMAIL]" in found[i]["sanitised"]
    assert all(found[i]["spans"] == "" for i in range(200))


# ------------------------------------------------------------------ WARC


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "MERGE_ROWS", 7)
    same, odd = "s" * 150, "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "日" * 100
    rows = [(i, f"http://h{i % 3}.example.org/p{i % 5}?q={i}", same if i % 2 else f"{i} " * 60) for i in range(40)]
    rows += [(50, None, None), (51, "x\r\ny", ""), (52, "u", odd), (53, "u", odd), (53, "u", odd), (54, "u", "short")]
    rows += [(55, "v", "short"), (None, "w", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for hot in (warc.HOT_PAYLOADS, 1):
        monkeypatch.setattr(warc, "HOT_PAYLOADS", hot)
        index = warc.histories(pages)
        found = rows_of(index, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        first = {}
        for page, _, html in rows:
            if page is not None:
                first[html or ""] = min(page, first.get(html or "", page))
        expected = Counter()
        for page, _, html in rows:
            payload = (html or "").encode()
            other = first.get(html or "")
            revisit = len(payload) >= 100 and other is not None and page != other
            expected[
                page, len(payload), brute.sha(html or ""), "revisit" if revisit else "response", other if revisit else None
            ] += 1
        assert found == expected
        keys = [(r["url_key"], r["captured"], r["page_id"] is None, r["page_id"] or 0) for r in index.collect()]
        # NULL ids sort first in ranges and stand for the time of the first capture.
        assert [k[:2] for k in keys] == sorted(k[:2] for k in keys)


def test_loser_tree():
    rng = random.Random(2)
    for runs in range(6):
        lists = [sorted((0, rng.randrange(50), i, j) for j in range(rng.randrange(0, 20))) for i in range(runs)]
        assert list(warc.LoserTree(lists)) == sorted(x for run in lists for x in run)


# ------------------------------------------------------------------ conversations


def repaired(spark, talks):
    rows = [(c, t, r, x) for c, turns in talks.items() for t, (r, x) in enumerate(turns)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {}
    for r in sorted(chat.repair_roles(docs).collect(), key=lambda r: (r["conv_id"], r["place"])):
        out.setdefault(r["conv_id"], []).append(r)
    return out


def turns_of(rendered):
    return [part.split("|>\n", 1) for part in rendered.split("<|end|>\n") if part]


@pytest.mark.parametrize("block", [512, 2])
def test_repairs_are_legal_and_cheapest(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(block)
    names = ["user", "assistant", "system", "tool", None, " Human "]
    talks = {
        i: [(rng.choice(names), rng.choice(["hi", "", None, "a <|user|> b"])) for _ in range(rng.randrange(1, 7))]
        for i in range(120)
    }
    found = repaired(spark, talks)
    assert set(found) == set(talks)
    for conv, turns in talks.items():
        roles = [(r or "").strip().lower() for r, _ in turns]
        roles = ["user" if r == "human" else r for r in roles]
        rows = found[conv]
        assert sum(r["cost"] for r in rows) == brute.cheapest_repair(
            roles, chat.MERGE, chat.INSERT, chat.RELABEL, chat.ROLES
        )
        said = turns_of("".join(r["rendered"] for r in rows))
        order = [name.removeprefix("<|") for name, _ in said]
        plain = order[1:] if order[0] == "system" else order
        assert plain and plain == ["user", "assistant"] * (len(plain) // 2)
        kept = "\n".join(text for _, text in said)
        for _, text in turns:
            assert (text or "").replace("<|", "< |") in kept


def test_very_long_conversations_and_ties(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 50)
    rng = random.Random(8)
    long = [(rng.choice(["user", "assistant"]), str(i)) for i in range(2000)]
    found = repaired(spark, {1: long, 2: [("user", "q")]})
    assert [r["place"] for r in found[1]] == list(range(2000))
    whole = chat.repair([r for r, _ in long], chat.START, None)
    costs = [chat.STEPS[r][a][b][0] for (r, _), (a, b, _) in zip(long, whole, strict=True)]
    assert sum(r["cost"] for r in found[1]) == sum(costs) + chat.end_costs()[whole[-1][1]]
    order = [n.removeprefix("<|") for n, _ in turns_of("".join(r["rendered"] for r in found[1]))]
    assert order == ["user", "assistant"] * (len(order) // 2)
    tied = spark.createDataFrame(
        [(None, None, "user", "a"), (None, None, "user", "a"), (3, 1, None, None), (3, 1, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    assert chat.repair_roles(tied).count() == 4


# ------------------------------------------------------------------ weak labels


def test_scores_agree_with_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = weak_labels.classify(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = found.join(labels, "doc_id").select("quality", "kept").collect()
    right = sum((r["quality"] == 1) == r["kept"] for r in rows) / len(rows)
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert right >= 0.95
    assert sum(good) / len(good) >= 0.99


def test_scores_of_awkward_rows(spark, edge):
    found = weak_labels.classify(edge).collect()
    assert len(found) == edge.count()
    assert all(r["score"] == 0 and not r["kept"] for r in found if r["doc_id"] in (1, 2, 3))


def test_accuracies_are_recovered():
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75])
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(np.int8)
    votes[rng.random(votes.shape) < 0.2] = weak_labels.ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, model = weak_labels.estimate(patterns, counts.astype(float))
    said_good, said_bad = model["chances"][0][0], model["chances"][0][1]
    assert model["prior"] == pytest.approx(0.7, abs=0.02)
    assert said_good / (said_good + said_bad) == pytest.approx(right, abs=0.03)
