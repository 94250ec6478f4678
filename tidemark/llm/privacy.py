"""Information-theoretic sanitisation of personal data.

Protected entities are e-mail addresses, IP addresses, card and phone numbers, found by
patterns. The corpus then tells which other terms give an entity away: a term that
stands in texts with an entity, and hardly in texts without it, lets a reader restore
what the pattern removed. Its disclosure is the posterior P(entity | term) over all
documents and its gain in bits over P(entity), as a share of -log2 P(entity). Terms above the first threshold are
generalised, above the second removed, wherever they stand in the documents that hold
the entity.

All of it is DataFrame expressions. Positions of matches come from the lengths of what
lies between them, summed up by a window over the matches of one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import staged, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
ACTIONS = ["generalised", "removed"]

# Code points on either side of an entity in which terms are looked for (None: the whole text),
# and what counts as one.
CONTEXT: int | None = 64
TERM = r"[\p{L}\p{M}\p{N}]+"
# A pair of term and entity needs so many different texts. The term must give away this share of
# what there is to give away, -log2 P(entity), and do so often enough that chance does not
# explain it: so many bits over all rows with both. Neither depends on the size of the table.
SUPPORT = 2
GAIN = 0.5
EVIDENCE_BITS = 6.0
GENERALISE, REMOVE = 0.5, 0.9
# Candidate terms up to this number are broadcast to the count over the corpus.
BROADCAST_TERMS = 200_000

LABEL = "A-Za-z0-9-"
DOT, OTHER = "\ue000", "\ue001"  # for private use, so texts hardly have them
# The patterns avoid repeated groups, which a regular expression engine may handle by
# recursion, and begin only where a match can: both keep long runs linear.
PATTERNS = {
    # Dots between labels are written DOT beforehand, so that a domain is one character class.
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+{DOT}-]))[A-Za-z0-9._%+{DOT}-]++@[{LABEL}]++{DOT}[{LABEL}{DOT}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Longer and shorter chains of digits fail the count of 16 to 19 anyway.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must contain for a pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
REPLACEMENTS = {
    "email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": "",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _candidates(kind: str) -> Column:
    """All matches of one kind, with the length of the text before each."""
    text = F.col("__text")
    if kind == "email":
        text = F.regexp_replace(F.translate(text, DOT, OTHER), rf"(?<=[{LABEL}])\.(?=[{LABEL}])", DOT)
    pattern = PATTERNS[kind]
    back = (lambda c: F.translate(c, DOT, ".")) if kind == "email" else (lambda c: c)

    def listed(both: Column) -> Column:
        found, gaps = both["found"], both["gaps"]
        return F.transform(
            found,
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("at"),
                F.length(F.get(gaps, i)).alias("gap"),
                back(x).alias("value"),
            ),
        )

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    # The text is searched once, and split only where there is something to find.
    some = F.element_at(F.transform(F.array(both), listed), 1)
    none = F.array().cast("array<struct<kind:string,at:int,gap:int,value:string>>")
    tried = F.contains("__text", F.lit(HINTS[kind])) & F.col("__text").rlike(
        pattern if kind != "email" else "@"
    )
    return F.when(tried, some).otherwise(none)


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.translate(value, " -", ""))
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == "ip", value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", _luhn(value))
        .when(kind == "phone", digits.between(8, 15))
        .otherwise(F.lit(True))
    )


def find_entities(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged documents (row, doc_id, same, text where needed), and base spans of the rows.

    ``same`` is equal for equal texts.
    """
    scanned = (
        docs.select("doc_id", text_or_empty().alias("__text"))
        .withColumn("found", F.concat(*[_candidates(k) for k in KINDS]))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("__text").alias("same"),
            F.when(F.size("found") > 0, F.col("__text")).alias("text"),
            "found",
        )
    )
    scanned = staged(scanned, "pii-docs")
    order = Window.partitionBy("row", "kind").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        scanned.filter(F.size("found") > 0)
        .select("row", "same", F.explode("found").alias("x"))
        .select("row", "same", "x.*")
        .withColumn("size", F.length("value"))
        .withColumn("end", (F.sum("gap").over(upto) + F.sum("size").over(upto)).cast("int"))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter(_valid(F.col("kind"), F.col("value")))
        .select("row", "same", "kind", "start", "end", "value")
    )
    return scanned, staged(spans, "pii-spans")


def _entity() -> Column:
    return F.xxhash64("kind", F.lower(F.regexp_replace("value", r"[^\p{L}0-9@.]", "")))


def _words(text: Column) -> Column:
    """The different words of a text."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def _near(text: Column, span: Column, context: int) -> Column:
    """Words that lie within the context of a span."""
    # One code point more is read; a word that has it reaches beyond the context.
    size = F.least(span["start"], F.lit(context + 1))
    before, after = F.substring(text, span["start"] - size + 1, size), F.substring(text, span["end"] + 1, F.lit(context + 1))
    before = F.when(size <= context, before).otherwise(F.regexp_replace(before, f"^{TERM}", ""))
    after = F.when(F.length(after) <= context, after).otherwise(F.regexp_replace(after, f"{TERM}$", ""))
    return _words(F.concat(before, F.lit(" "), after))


def _masked(scanned: DataFrame, spans: DataFrame, context: int | None) -> DataFrame:
    """Rows with an entity: row, same, masked, changed, near.

    ``masked`` is the text with blanks in place of base spans, so what stands in it keeps
    its position and no term overlaps a base span. ``changed`` lists words that only the
    mask shows (1) or that it hides (-1), ``near`` the words near each entity.
    """
    past = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    lists = (
        spans.select("row", "start", "end", _entity().alias("entity"))
        .withColumn("from", F.coalesce(F.max("end").over(past), F.lit(0)))
        .groupBy(F.col("row").alias("r"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "from", "entity"))).alias("all"))
        .withColumn("covers", F.filter("all", lambda s: s["end"] > s["from"]))
    )
    text = F.col("text")
    pieces = F.transform(
        "covers",
        lambda c: F.concat(
            F.substring(text, c["from"] + 1, F.greatest(F.lit(0), c["start"] - c["from"])),
            F.repeat(F.lit(" "), c["end"] - F.greatest(c["start"], c["from"])),
        ),
    )
    rest = F.substring(text, F.element_at("covers", -1)["end"] + 1, F.length(text))

    def moved(both: Column) -> Column:
        def listed(words: Column, step: int) -> Column:
            return F.transform(words, lambda x: F.struct(x.alias("word"), F.lit(step).alias("step")))

        shown, hidden = F.array_except(both["new"], both["old"]), F.array_except(both["old"], both["new"])
        return F.concat(listed(shown, 1), listed(hidden, -1))

    def near(masked: Column) -> Column:
        if context is None:
            of = F.array_distinct(F.transform("all", lambda s: s["entity"]))
            return F.transform(of, lambda e: F.struct(e.alias("entity"), _words(masked).alias("terms")))
        return F.transform("all", lambda s: F.struct(s["entity"].alias("entity"), _near(masked, s, context).alias("terms")))

    return (
        scanned.join(lists, F.col("row") == F.col("r"))
        .withColumn("masked", F.concat(F.array_join(pieces, ""), rest))
        .withColumn("both", F.array(F.struct(_words(F.col("masked")).alias("new"), _words(text).alias("old"))))
        .withColumn("shown", F.array("masked"))
        .select(
            "row",
            "same",
            "masked",
            F.element_at(F.transform("both", moved), 1).alias("changed"),
            F.element_at(F.transform("shown", near), 1).alias("near"),
        )
    )


def _places(masked: DataFrame) -> DataFrame:
    """All words of the rows with their positions: row, term, start, end."""

    def listed(both: Column) -> Column:
        return F.transform(
            both["found"],
            lambda x, i: F.struct(
                i.alias("at"),
                F.lower(x).alias("term"),
                F.length(F.get(both["gaps"], i)).alias("gap"),
                F.length(x).alias("size"),
            ),
        )

    text = F.col("masked")
    both = F.struct(
        F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("found"), F.split(text, TERM, -1).alias("gaps")
    )
    upto = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        masked.select("row", F.explode(F.element_at(F.transform(F.array(both), listed), 1)).alias("x"))
        .select("row", "x.*")
        .withColumn("end", (F.sum("gap").over(upto) + F.sum("size").over(upto)).cast("int"))
        .select("row", "term", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def disclosing_terms(
    docs: DataFrame, scanned: DataFrame, spans: DataFrame, context: int | None = CONTEXT
) -> DataFrame:
    """Spans of terms that give away an entity of their text: row, kind, start, end.

    A term of a text with an entity is a candidate, with a ``context`` one that stands near it in
    any text. What it discloses is counted over all texts that hold both, however far apart, and
    it goes wherever it stands in them.
    """
    held = staged(spans.select("row", "same", _entity().alias("entity")).distinct(), "pii-held")
    masked = staged(_masked(scanned, spans, context), "pii-masked")
    # Entities of fewer different texts than a pair needs have no pair.
    entities = (
        held.groupBy("entity", "same").agg(F.count("*").alias("rows"))
        .groupBy(F.col("entity").alias("e")).agg(F.sum("rows").alias("entity_docs"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= SUPPORT).drop("texts")
    )
    near = masked.select(F.explode("near").alias("x")).select("x.entity", "x.terms")
    pairs = (
        near.join(entities, F.col("entity") == F.col("e"))
        .select("entity", "entity_docs", F.explode("terms").alias("term"))
        .distinct()
    )
    pairs = staged(pairs, "pii-pairs")
    terms = pairs.select(F.col("term").alias("wanted")).distinct()
    few = terms.count() <= BROADCAST_TERMS
    everywhere = docs.select(F.explode(_words(text_or_empty())).alias("word"), F.lit(1).alias("step"))
    changed = masked.select(F.explode("changed").alias("x")).select("x.*")
    spoken, wanted = everywhere.union(changed), F.col("word") == F.col("wanted")
    if few:
        spoken = spoken.join(F.broadcast(terms), wanted, "left_semi")
    counts = spoken.groupBy("word").agg(F.sum("step").alias("term_docs"))
    if not few:
        # Frequent words are added up before anything is shuffled, then wanted ones are kept.
        counts = counts.join(terms, wanted, "left_semi")
    total = scanned.count()

    def disclosed(both: Column) -> tuple[Column, Column]:
        """The posterior, and whether the gain is a large enough share and no chance."""
        posterior = F.least(F.lit(1.0), both / F.col("term_docs"))
        most = F.log2(F.lit(total) / F.col("entity_docs"))
        bits = F.log2(posterior) + most
        return posterior, (bits > 0) & (bits >= GAIN * most) & (both * bits >= EVIDENCE_BITS)

    # Texts with both are at most those with either, which leaves few pairs to look up.
    posterior, tells = disclosed(F.least("entity_docs", "term_docs"))
    possible = (
        pairs.join(counts, F.col("term") == F.col("word")).drop("word")
        .filter((F.col("term_docs") >= SUPPORT) & (posterior >= GENERALISE) & tells)
    )
    possible = staged(possible, "pii-possible")
    looked_up = possible.select(F.col("term").alias("pt"), F.col("entity").alias("pe"))
    if looked_up.count() <= BROADCAST_TERMS:
        looked_up = F.broadcast(looked_up)
    both = (
        masked.select("row", "same", F.explode(_words(F.col("masked"))).alias("term"))
        .join(looked_up, F.col("term") == F.col("pt"))
        .select("row", "same", "term", F.col("pe").alias("entity"))
        .join(held.select("row", "entity"), ["row", "entity"], "left_semi")
    )
    both = staged(both, "pii-both")
    together = (
        both.groupBy("term", "entity", "same").agg(F.count("*").alias("rows"))
        .groupBy(F.col("term").alias("tt"), F.col("entity").alias("te"))
        .agg(F.sum("rows").alias("both"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= SUPPORT)
    )
    posterior, tells = disclosed(F.col("both"))
    telling = (
        possible.join(together, (F.col("term") == F.col("tt")) & (F.col("entity") == F.col("te")))
        .filter((posterior >= GENERALISE) & tells)
        .select("tt", "te", F.when(posterior >= REMOVE, F.lit("removed")).otherwise(F.lit("generalised")).alias("kind"))
    )
    telling = staged(telling, "pii-telling")
    if telling.count() <= BROADCAST_TERMS:
        telling = F.broadcast(telling)
    marked = (
        both.join(telling, (F.col("term") == F.col("tt")) & (F.col("entity") == F.col("te")))
        .groupBy(F.col("row").alias("mr"), F.col("term").alias("mt")).agg(F.max("kind").alias("kind"))
    )
    marked = staged(marked, "pii-marked")
    concerned = masked.join(marked.select("mr").distinct(), F.col("row") == F.col("mr"), "left_semi")
    return (
        _places(concerned).join(marked, (F.col("row") == F.col("mr")) & (F.col("term") == F.col("mt")))
        .select("row", "kind", "start", "end")
    )


def _written(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced; a span that begins inside another goes with it."""
    in_order = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    # Each span begins after the furthest end of those before it.
    pieces = F.aggregate(
        in_order,
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(
                F.array_append(
                    a["out"],
                    F.concat(
                        F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                        reduce(
                            lambda c, k: c.when(s["kind"] == k, REPLACEMENTS[k]),
                            list(REPLACEMENTS)[1:],
                            F.when(s["kind"] == "email", REPLACEMENTS["email"]),
                        ),
                    ),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    return pieces


def sanitise(docs: DataFrame, render: bool = False, context: int | None = CONTEXT) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are written ``kind:start:end`` in code points, end exclusive, by kind and then
    by start; base spans come first, as they are, then terms with what is done to them.
    With ``render``, texts with spans also come back sanitised (others as NULL: nothing
    changes). NULL and empty texts have no spans; repeated rows are treated one by one;
    only doc_id and text are read, so other columns may have any name. Texts are read
    whole, however long, and documents without an entity are left alone. An empty table
    gives no rows. Terms are looked for within ``context`` code points of an entity, and
    counted and replaced wherever they stand; ``context=None`` looks in whole texts, which also
    finds names far from the entity, and in groups of near copies most of their rare words.
    """
    scanned, spans = find_entities(docs)
    terms = disclosing_terms(docs, scanned, spans, context)
    every = spans.select("row", "kind", "start", "end").unionByName(terms)
    rank = F.array_position(F.array(*map(F.lit, KINDS + ACTIONS)), F.col("kind"))
    lists = every.groupBy(F.col("row").alias("r")).agg(
        F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("all")
    )
    empty = F.array().cast("array<struct<rank:bigint,start:int,end:int,kind:string>>")
    joined = scanned.select("row", "doc_id", "text").join(lists, F.col("row") == F.col("r"), "left").withColumn(
        "all", F.coalesce("all", empty)
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("all", lambda s: s["rank"] <= len(KINDS))
    out = ["doc_id", *map(count, KINDS), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("all")).alias("spans")]
    if render:
        out.append(F.when(F.size("all") > 0, _sanitised(F.col("text"), F.col("all"))).alias("sanitised"))
    return joined.select(*out)
