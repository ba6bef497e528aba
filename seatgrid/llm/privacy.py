"""Personal data: fixed patterns, and terms that the corpus shows to reveal them.

Protected entities are the addresses and numbers that the patterns find, each as a kind (``email``) and as a value (one address). Over
all different texts two things are counted: in how many of them a term stands together with an entity, and in how many it stands at
all. With IC(c) = -log p(c) of an entity c and PMI(c; t) = log p(c | t) / p(c), a term t discloses PMI(c; t) / IC(c) of what c tells
(1 if c is in every text that has t). A term counts only if its company is no chance: for k of its n texts, the chance of as many at
rate p(c) is below exp(-n KL(k/n, p(c))) (Chernoff), and that times the number of pairs looked at has to be below ``CHANCE``.

A term that tells half of a kind is generalised to a label in every text that holds an entity of the kind; one that tells nine tenths
of it is removed. A term that tells nine tenths of one value is treated so wherever it stands. All of it is DataFrame
expressions; texts are parsed once and kept with their spans, and a term's texts are counted only where it can reach the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import stored

# Fixed values. The patterns match what the plain ones do (given beside them), but every repetition is possessive
# and starts are tied to the front of a run, so that long runs take linear time and no recursion.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
WORD = r"[\p{L}\p{M}\p{N}_'’-]+"
BYTE_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"

#: Shares of what an entity tells from which a term is generalised, or removed; of a value only the second counts.
GENERALISE_AT = 0.5
REMOVE_AT = 0.9
#: The chance that any term of the corpus counts that stands with its entity by chance.
CHANCE = 0.01
CHUNK = 64
BLOCK = 512
#: Codec of the many small tables.
SMALL = "snappy"
SPAN = "struct<start:int,end:int,value:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, join: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For each place of an array of numbers from 0 up the join (sum, or greatest) of all before it; 0 for the first.

    An array is built up by copying it for each element, so this is done in chunks, and for the chunks' results in chunks again.
    """

    def scan(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda acc, x: F.struct(
            join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        ))

    if levels == 0:
        return scan(values)["out"]

    def chunked(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / CHUNK).cast("int"))
        chunks = F.transform(places, lambda i: scan(F.slice(whole, i * CHUNK + 1, F.lit(CHUNK))))

        def shifted(parts: Column) -> Column:
            offsets = _before(F.transform(parts, lambda p: p["at"]), join, levels - 1)
            both = F.arrays_zip(parts.alias("part"), offsets.alias("offset"))
            return F.flatten(F.transform(both, lambda b: F.transform(b["part"]["out"], lambda v: join(v, b["offset"]))))

        return F.when(F.size(whole) > 0, _let(chunks, shifted)).otherwise(F.array().cast("array<int>"))

    return _let(values, chunked)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as ``array<struct<start, end, value>>`` in code points."""

    def placed(found: Column, whole: Column) -> Column:
        gaps = F.slice(F.split(whole, pattern, -1), F.lit(1), F.size(found))
        steps = F.arrays_zip(found.alias("value"), F.transform(gaps, F.char_length).alias("gap"))

        def spans(steps: Column) -> Column:
            before = _before(F.transform(steps, lambda s: s["gap"] + F.char_length(s["value"])), _sum)
            return F.transform(F.arrays_zip(steps.alias("step"), before.alias("before")), lambda s: F.struct(
                (s["before"] + s["step"]["gap"]).alias("start"),
                (s["before"] + s["step"]["gap"] + F.char_length(s["step"]["value"])).alias("end"), s["step"]["value"].alias("value"),
            ))

        return F.when(F.size(found) > 0, _let(steps, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return _let(text, lambda whole: _let(F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)), lambda found: placed(found, whole)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.reverse(F.split(_digits(value), ""))
    digits = F.filter(digits, lambda d: d != "")

    def weigh(d, i):
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return n - F.when(n > 9, 9).otherwise(0)

    return F.aggregate(F.transform(digits, weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(BYTE_PARTS),
    "card": luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def base_spans(text: Column) -> Column:
    """Spans of all kinds, ``array<struct<start, order, end, kind, value>>`` by start, then kind as listed."""

    def spans_of(order: int, kind: str) -> Column:
        good = F.filter(matches(text, KINDS[kind]), lambda m: CHECKS[kind](m["value"]))
        return F.transform(good, lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")
        ))

    return F.array_sort(F.concat(*[spans_of(order, kind) for order, kind in enumerate(KINDS)]))


def _replaced(text: Column, spans: Column, by: Callable[[Column, Column], Column]) -> Column:
    """``text`` with what its spans (in order) cover replaced by ``by(first span, covered length)``; spans that overlap count as one.

    The text is cut into blocks first, and every piece is taken out of the blocks it lies in.
    """

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
        head = F.coalesce(F.get(blocks, first), F.lit(""))
        inner = F.concat(
            F.substring(head, start % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end % BLOCK),
        )
        return F.when(first == last, F.substring(head, start % BLOCK + 1, end - start)).otherwise(inner)

    def rebuilt(text: Column, spans: Column, ends: Column, blocks: Column) -> Column:
        covered = F.arrays_zip(spans.alias("span"), F.slice(ends, F.lit(1), F.size(spans)).alias("before"))
        # A span that starts behind all before it starts a stretch, which ends where the next one's spans before it end.
        def joined(firsts: Column) -> Column:
            def own(s: Column, i: Column) -> Column:
                following = F.get(firsts, i + 1)
                end = F.coalesce(following["before"], F.element_at(ends, -1))
                upto = F.coalesce(following["span"]["start"], F.char_length(text))
                return F.concat(by(s["span"], end - s["span"]["start"]), piece(blocks, end, upto))

            return F.concat(piece(blocks, F.lit(0), firsts[0]["span"]["start"]), F.array_join(F.transform(firsts, own), ""))

        return _let(F.filter(covered, lambda c: c["span"]["start"] >= c["before"]), joined)

    def bound(both: Column) -> Column:
        text, spans = both["text"], both["spans"]
        ends = F.transform(spans, lambda s: s["end"])
        # One more entry than spans: the last is what all of them reach.
        scans = _let(_before(F.concat(ends, F.array(F.lit(0))), F.greatest), lambda e: _let(
            F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda blocks: rebuilt(text, spans, e, blocks)
        ))
        return F.when(F.size(spans) > 0, scans).otherwise(text)

    return _let(F.struct(text.alias("text"), spans.alias("spans")), bound)


def _label(span: Column, covered: Column) -> Column:
    return F.when(span["kind"] == "removed", F.lit("")).otherwise(F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))


def _blanked(text: Column, spans: Column) -> Column:
    """Blanks in place of the spans, so that all other words keep their places."""
    return _replaced(text, spans, lambda span, covered: F.repeat(F.lit(" "), covered))


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _text() -> Column:
    return F.coalesce(F.col("row.text").cast("string"), F.lit(""))


def parsed_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (a struct ``row`` with ``text``) with their ``base`` spans, a number and a hash of the text, stored."""
    keyed = rows.select("row", F.xxhash64(_text()).alias("key1"), F.xxhash64(F.lit(1), _text()).alias("key2"), base_spans(_text()).alias("base"))
    return stored(keyed.withColumn("number", F.monotonically_increasing_id()), "privacy-texts", "snappy")


def copies_of(texts: DataFrame) -> tuple[DataFrame, int]:
    """Numbers of the rows whose text another row with a smaller number has, too, and how many different texts there are."""
    light = texts.select("key1", "key2", "number")
    groups = stored(light.groupBy("key1", "key2").agg(F.min("number").alias("least"), F.count(F.lit(1)).alias("rows")), "privacy-groups", SMALL)
    # Only the keys of copied texts, to be broadcast where they are few; a text with very many copies is one of them.
    copied = stored(groups.filter("rows > 1").select("key1", "key2", "least"), "privacy-copied", SMALL)
    copies = light.join(copied, ["key1", "key2"]).filter("number <> least").select("number")
    return stored(copies, "privacy-copies", SMALL), groups.count()


def disclosure(hits: Column, with_term: Column, with_entity: Column, texts: int) -> Column:
    """Share of an entity's information that a term gives away, from numbers of texts; null for an entity of every text."""
    return 1 - F.try_divide(F.log2(hits / with_term), F.log2(with_entity / F.lit(float(texts))))


def evidence(hits: Column, with_term: Column, with_entity: Column, texts: int) -> Column:
    """Minus the logarithm of a bound on the chance of so many texts with both, if they had nothing to do with each other."""
    share, rate = hits / with_term, with_entity / F.lit(float(texts))
    apart = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, with_term * (share * F.log(share / rate) + apart)).otherwise(0.0)


def disclosing_terms(texts: DataFrame) -> DataFrame:
    """``level, entity, term, disclosure`` of the terms that reach the thresholds; ``texts`` is :func:`parsed_texts`.

    Numbers are of different texts, over all rows: copies of a text say one thing once. Words inside entities are no terms.
    """
    copies, many = copies_of(texts)
    single = texts.join(copies, "number", "left_anti")
    holders = single.filter(F.size("base") > 0)
    # Plain texts, of which Spark keeps a set while it looks for different ones.
    kinds = F.array_distinct("base.kind")
    values = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    of_kind = holders.select("number", F.lit("kind").alias("level"), F.explode(kinds).alias("entity"))
    of_value = holders.select("number", F.lit("value").alias("level"), F.explode(values).alias("entity"))
    needed = F.when(F.col("level") == "kind", GENERALISE_AT).otherwise(REMOVE_AT)
    n, hits, with_term = F.col("with_entity"), F.col("hits"), F.col("with_term")
    # What stands with a value of one text is any word of that text; there is nothing to tell them apart by.
    named = of_kind.union(of_value)
    entities = stored(
        named.groupBy("level", "entity").agg(F.count(F.lit(1)).alias("with_entity")).filter((F.col("level") == "kind") | (n > 1)), "privacy-entities", SMALL
    )
    named = stored(named.join(entities, ["level", "entity"]), "privacy-named", SMALL)
    spoken = holders.select("number", F.explode(_words(_blanked(_text(), F.col("base")))).alias("term"))
    pairs = named.join(spoken, "number")
    both = stored(
        pairs.groupBy("level", "entity", "term").agg(
            F.first("with_entity").alias("with_entity"), F.count(F.lit(1)).alias("hits")
        ),
        "privacy-pairs", SMALL,
    )
    certain = math.log(max(both.count(), 1) / CHANCE)
    # A term that falls short even if all its texts held the entity is not looked for elsewhere.
    able = stored(both.filter(evidence(hits, hits, n, many) >= certain), "privacy-able", SMALL)
    terms = stored(able.select("term").distinct(), "privacy-terms", SMALL)
    words = single.select(F.explode(_words(F.when(F.size("base") > 0, _blanked(_text(), F.col("base"))).otherwise(_text()))).alias("term"))
    # Counted before they meet the terms, so that words are not shuffled one by one, however many terms there are.
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("with_term")).join(terms, "term")
    # Stored pairs take twenty times their file's size in memory, so their size does not say whether they can be broadcast.
    told = able.hint("merge").join(counts, "term").filter(evidence(hits, with_term, n, many) >= certain).select(
        "level", "entity", "term", disclosure(hits, with_term, n, many).alias("disclosure")
    )
    return stored(told.filter(F.col("disclosure") >= needed), "privacy-disclosing", SMALL)


def _all_spans(rows: DataFrame) -> DataFrame:
    """``row``, ``text``, ``base`` (spans of the patterns) and ``spans`` (these and the method's) of every row.

    Texts that hold entities and the others are marked apart: most texts are of the others, and few of these have marks, so that they
    need not be shuffled to meet them.
    """
    texts = parsed_texts(rows)
    told = disclosing_terms(texts)
    label = F.when(F.col("disclosure") >= REMOVE_AT, "removed").otherwise("term")

    def worst(level: str, *keys: str) -> DataFrame:
        return stored(told.filter(F.col("level") == level).groupBy(*keys).agg(F.max("disclosure").alias("disclosure")), f"privacy-{level}-terms", SMALL)

    def marks(found: DataFrame, name: str) -> DataFrame:
        each = found.groupBy("number", "term").agg(F.max("disclosure").alias("disclosure"))
        each = each.groupBy(F.col("number").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("term", label.alias("kind")))).alias("marks"))
        return stored(each, f"privacy-marks-{name}", SMALL)

    holders, others = texts.filter(F.size("base") > 0), texts.filter(F.size("base") == 0)
    spoken = holders.select("number", F.array_distinct("base.kind").alias("kinds"), F.explode(_words(_blanked(_text(), F.col("base")))).alias("term"))
    found = spoken.join(worst("kind", "entity", "term"), "term").filter(F.array_contains("kinds", F.col("entity"))).select("number", "term", "disclosure")
    unmarked = F.lit(None).cast("map<string,string>").alias("marks")
    if told.filter("level = 'value'").first():
        values = worst("value", "term")
        found = found.union(spoken.join(values, "term").select("number", "term", "disclosure"))
        elsewhere = others.select("number", F.explode(_words(_text())).alias("term")).join(values, "term").select("number", "term", "disclosure")
        others = others.join(marks(elsewhere, "others"), F.col("number") == F.col("of"), "left").select("row", "base", "marks")
    else:
        others = others.select("row", "base", unmarked)
    holders = holders.join(marks(found, "holders"), F.col("number") == F.col("of"), "left").select("row", "base", "marks")
    joined = holders.union(others).select("row", _text().alias("text"), "base", "marks")
    words = F.transform(matches(_blanked(F.col("text"), F.col("base")), WORD), lambda m: F.struct(
        m["start"].alias("start"), F.lit(len(KINDS)).alias("order"), m["end"].alias("end"), F.element_at("marks", F.lower(m["value"])).alias("kind"),
        F.lit("").alias("value"),
    ))
    extra = F.filter(words, lambda w: w["kind"].isNotNull())
    spans = F.when(F.col("marks").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", extra)))
    return joined.select("row", "text", "base", spans.alias("spans"))


def _sanitised(text: Column, spans: Column) -> Column:
    return _replaced(text, spans, _label)


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans, sanitised`` of every row; a null text counts as empty.

    Spans are ``struct<start, order, end, kind, value>`` in code points, end exclusive, by start, then kind as listed
    (email, ip, card, phone, then the method's ``term`` and ``removed``). Repeated rows get equal results. An empty table gives an
    empty table, null ids stay null, other columns are left out. Time grows in proportion to the length of a text, but for
    sorting its spans.
    """
    rows = _all_spans(docs.select(F.struct(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).alias("row")))
    return rows.select("row.doc_id", "base", "spans", _sanitised(F.col("text"), F.col("spans")).alias("sanitised"))


def span_list(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``text`` and others) with texts sanitised and ``n_chars``, where there is one, counted anew.

    A null text stays null.
    """
    rows = _all_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    clean = F.when(F.col("row.text").isNotNull(), _sanitised(F.col("text"), F.col("spans")))
    rows = rows.select("row", clean.alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
