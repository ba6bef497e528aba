"""Quality, near-duplicates, personal data, mixing and the pipeline against brute force, and on edge rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from seatgrid.llm import mixing, privacy, quality, queries, simhash
from seatgrid.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_stats(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_op10_statistics_and_verdicts(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op10_quality_rules(spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, *_ in documents:
        r, want = rows[doc_id], plain_stats(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t|\x0b  #\x1cÉ", max_size=80))
def test_statistics_of_odd_texts(text):
    assert quality._stats(text)[:5] == plain_stats(text)


def test_windows_of_one_sum_are_told_apart(monkeypatch):
    """With a factor of 1 a sum forgets the order of the words."""
    words = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
    text = words + words[::-1] + [b"x"] * 3 + words[2:] + words[:2]
    want = plain_stats(b" ".join(text).decode())[4]
    assert quality._repeated(text) == want
    monkeypatch.setattr(quality, "_NOT_REPEATED", np.uint64(1))
    assert quality._repeated(text) == want
    assert quality._repeated(words * 2) == 16


def test_few_texts_are_fitted_together(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(30, 5)).tolist()
    rows = [("=en", f"=s{i % 7}", v) for i, v in enumerate(vectors)]
    schema = "cell_lang string, cell_source string, vector array<double>"
    assert quality.fit_quality(spark.createDataFrame(rows, schema)).count() == 7
    assert quality.fit_quality(spark.createDataFrame(rows[:27], schema)).count() == 0


def plain_mcd(v: np.ndarray, steps: int = 4) -> np.ndarray:
    middle = np.sort(v, 0)[(len(v) - 1) // 2]
    cov = np.diag(np.maximum(1.4826 * np.sort(abs(v - middle), 0)[(len(v) - 1) // 2], 1e-4) ** 2)
    for step in range(steps + 1):
        gaps = v - middle
        d = ((gaps @ np.linalg.inv(cov)) * gaps).sum(1)
        if step < steps:
            own = v[d <= np.sort(d)[int(np.ceil(quality.SHARE * len(v))) - 1]]
            middle, cov = own.mean(0), np.cov(own.T, bias=True) / quality.SHRUNK + 1e-4 * np.eye(v.shape[1])
    return d


def test_outliers_equal_a_plain_estimate(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(5, 5))
    groups = {("=en", "=a"): rng.normal(size=(400, 5)) @ mix, ("=en", "=b"): rng.normal(size=(230, 5)) + 3, ("=en", "=c"): rng.normal(size=(20, 5))}
    groups["=en", "=a"][:60] += 40
    rows = [(lang, source, v.tolist()) for (lang, source), vs in groups.items() for v in vs]
    table = spark.createDataFrame(rows, "cell_lang string, cell_source string, vector array<double>").coalesce(1)
    fits = {(r["cell_lang"], r["cell_source"]): r for r in quality.fit_quality(table).collect()}
    assert set(fits) == set(groups)
    pooled = np.concatenate(list(groups.values()))
    for key, vs in groups.items():
        used = pooled if key[1] == "=c" else vs
        gaps = used - np.array(fits[key]["centre"])
        got = ((gaps @ np.array(fits[key]["inverse"]).reshape(5, 5)) * gaps).sum(1)
        assert np.allclose(got, plain_mcd(used), rtol=0.05)
    gaps = groups["=en", "=a"] - np.array(fits["=en", "=a"]["centre"])
    far = ((gaps @ np.array(fits["=en", "=a"]["inverse"]).reshape(5, 5)) * gaps).sum(1) > quality.LIMIT
    assert far[:60].all() and not far[60:].any()


def test_quality_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = quality.quality(edge_docs).collect()
    assert sorted(plain_stats(r[1]) for r in edge_rows) == sorted(tuple(r)[1:6] for r in rows)
    assert quality.quality(no_docs).collect() == []
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality.keep_good(no_docs).collect() == []


def plain_print(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[tuple[int | None, int]]) -> dict[int, int | None]:
    """Fingerprint to smallest id of its component."""
    left, out = {p for _, p in prints}, {}
    while left:
        group, edge = set(), {left.pop()}
        while edge:
            group |= edge
            edge = {q for q in left if any((p ^ q).bit_count() <= 2 for p in edge)}
            left -= edge
        least = min((i for i, p in prints if p in group and i is not None), default=None)
        out |= dict.fromkeys(group, least)
    return out


def test_op7_equals_all_pairs(spark, documents):
    prints = [(d[0], plain_print(d[1])) for d in documents]
    least = plain_components(prints)
    rows = queries.op7_simhash_near_dedup(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted((i, f"{p:016x}", least[p]) for i, p in prints)


def test_links_between_chosen_fingerprints(spark):
    base = 0xF0F0_1234_5678_9ABC
    values = [base, base ^ 1, base ^ (1 << 63), base ^ (1 << 31) ^ (1 << 32), base ^ 7, base ^ 0x3F, 0, 3, 7 << 60, 1 << 63]
    values += [0xAAAA << 20 ^ (1 << i) for i in range(64)]  # a ball whose centre is not there
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = components(simhash.links(spark.createDataFrame(signed, "fingerprint long").distinct())).collect()
    got = {r["node"] % (1 << 64): r["root"] for r in found}
    want = plain_components([(v, v) for v in values])
    for a in values:
        for b in values:
            assert (got.get(a, a) == got.get(b, b)) == (want[a] == want[b])


@pytest.mark.parametrize("segments, radius, hot", [(2, 2, 256), (1, 2, 256), (3, 2, 256), (8, 2, 5), (2, 2, 4), (2, 3, 6), (5, 4, 3)])
def test_segment_tables_find_all_links(spark, monkeypatch, segments, radius, hot):
    """Random prints, families that share a segment's value, and values shared by more prints than the bound."""
    monkeypatch.setattr(simhash, "HOT_VALUE", hot)
    rng = np.random.default_rng(segments)
    values = {0, (1 << 64) - 1}
    for _ in range(8):
        centre = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(40):
            bits = rng.choice(64, rng.integers(0, 5), replace=False) if rng.random() < 0.7 else rng.choice(12, rng.integers(0, 9), replace=False)
            values.add(centre ^ sum(1 << int(b) for b in bits))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "fingerprint long")
    got = sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, segments, radius).collect())
    order = {v: v - (1 << 64) if v >> 63 else v for v in values}
    want = sorted((a, b) for a in values for b in values if order[a] < order[b] and (a ^ b).bit_count() <= radius)
    assert got == want and want
    assert simhash.links(frame.limit(0), segments, radius).collect() == []


def test_segments_change_the_candidates_only(spark):
    rng = np.random.default_rng(1)
    frame = spark.createDataFrame([(int(x),) for x in rng.integers(0, 4000, 600)], "fingerprint long").distinct()
    found = {m: simhash.candidates(frame, m).count() for m in (2, 4, 8)}
    assert len(set(found.values())) == 3
    assert len({tuple(sorted(map(tuple, simhash.links(frame, m).collect()))) for m in (1, 2, 4, 8)}) == 1
    with pytest.raises(ValueError):
        simhash.links(frame, 0)


def test_exploded_probes_are_not_broadcast(spark):
    """A fingerprint asks for 66 values, which Spark's estimate takes for one row."""
    prints = spark.range(2000).select(F.xxhash64("id").alias("fingerprint"))
    plan = simhash.candidates(prints)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in plan]
    sent = []
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            end = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
            sent += [below for below in plan[at + 1 : end] if "Generate explode" in below]
    assert not sent


def test_pairs_with_terms_are_not_broadcast(spark, monkeypatch):
    plans, kept = {}, privacy.stored

    def stored(df, name, *options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name, *options)

    monkeypatch.setattr(privacy, "stored", stored)
    texts = [(i, f"call +49 30 1234 5678 ask word{i % 3}", "en", "a", 9) for i in range(9)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    privacy.disclosing_terms(privacy.parsed_texts(rows.select(F.struct("*").alias("row"))))
    assert re.search(r"SortMergeJoin \[term#\d+\], \[term#\d+\], Inner, .*hits", plans["privacy-disclosing"])


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    loose = spark.createDataFrame([(1000, 1001), (1001, 1000), (7777, 7777)], "a long, b long")
    rows = dict(map(tuple, components(chain.union(loose)).collect()))
    assert rows == dict.fromkeys(range(301), 0) | {1000: 1000, 1001: 1000}


def test_near_duplicates_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    prints = [(r[0], plain_print(r[1])) for r in edge_rows]
    least = plain_components(prints)
    rows = simhash.near_duplicates(edge_docs).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr((i, f"{p:016x}", least[p])) for i, p in prints)
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == sorted((v is not None, v or 0) for v in set(least.values()))
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_first(no_docs).collect() == []


def passes_luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(n - 9 * (n > 9) for n in doubled) % 10 == 0


def plain_spans(text: str | None) -> str:
    out = []
    for order, (kind, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True, "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and passes_luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15,
            }
            if good[kind]():
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


TRICKY = [
    "a@b.c_d@e.f x..y@z.q a@b a@b. @c.d a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 0.0.0.0000", "4111 1111-1111 1111 4111111111111111 41111111111111111111",
    "+1 (974) 555-3436 +12345678 +1234567890123456 +1..2 ++1 222 333 4444", "😀é +49 30 1234567 😀 x@y.zz 4111  111111111111", "12-34-56-78-90-12 0000 0000 0000 0000 000",
]


def test_op8_equals_plain_patterns(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op8_private_data(spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, *_ in documents:
        want, r = plain_spans(text), rows[doc_id]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in privacy.KINDS] == [want.count(f"{k}:") for k in privacy.KINDS]
        assert not want or set(want.split(",")) <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def odd_texts():
    rng = np.random.default_rng(5)
    parts = ["a@b.c", "1", "22", ".", "-", " ", "+1", "@", "255.", "4111111111111111", "é", "(", "_x"]
    return TRICKY + ["".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(1500)]


def test_patterns_on_odd_texts(spark, odd_texts):
    docs = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string")
    rows = docs.select("doc_id", privacy.span_list(privacy.base_spans(F.col("text"))).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in rows} == {i: plain_spans(t) for i, t in enumerate(odd_texts)}


def test_terms_that_reveal_are_found(spark):
    rng = np.random.default_rng(2)
    words = [f"word{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    prose = lambda: " ".join(rng.choice(words, 30))
    texts = [f"{prose()} the informant Kestrel joe@x.org the end {prose()}" for _ in range(8)] + [f"{prose()} the {prose()}" for _ in range(200)]
    texts += [f"{prose()} once mentioned Lonely ann@x.org here"] + [texts[0]] * 5
    rows = privacy.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        text, kinds = texts[r["doc_id"]], {s["kind"] for s in r["spans"]}
        marked = {text[s["start"] : s["end"]] for s in r["spans"] if s["kind"] not in privacy.KINDS}
        if "joe@" in text:
            assert marked == {"informant", "Kestrel", "end"} and "Kestrel" not in r["sanitised"] and "<EMAIL>" in r["sanitised"]
        else:
            assert not marked and kinds <= {"email"}


def plain_disclosures(texts: list[str]) -> dict[tuple[str, str, str], float]:
    """Every disclosure at its threshold, counted text by text."""
    texts = sorted(set(texts))
    entities, words = [], []
    for text in texts:
        chars, own = list(text), set()
        for span in filter(None, plain_spans(text).split(",")):
            kind, start, end = span.split(":")
            own |= {("kind", kind), ("value", f"{kind}:{text[int(start) : int(end)].lower()}")}
            chars[int(start) : int(end)] = " " * (int(end) - int(start))
        entities.append(own)
        words.append(set(re.findall(r"[\w'’-]+", "".join(chars).lower())))
    with_entity, with_term = Counter(e for own in entities for e in own), Counter(w for own in words for w in own)
    hits = Counter((e, w) for own, said in zip(entities, words) for e in own for w in said)
    hits = {key: k for key, k in hits.items() if key[0][0] == "kind" or with_entity[key[0]] > 1}
    out, certain = {}, np.log(len(hits) / privacy.CHANCE)
    for (entity, word), k in hits.items():
        n, rate = with_term[word], with_entity[entity] / len(texts)
        if k / n <= rate:
            continue
        chance = k * np.log(k / n / rate) + (0 if k == n else (n - k) * np.log((1 - k / n) / (1 - rate)))
        share = 1 - np.log(k / n) / np.log(rate)
        if chance >= certain and share >= (privacy.GENERALISE_AT if entity[0] == "kind" else privacy.REMOVE_AT):
            out[*entity, word] = share
    return out


def test_disclosures_equal_plain_counts(spark):
    """Terms of a kind whose values stand once, of one value in many texts, and none by chance; copies count once."""
    rng = np.random.default_rng(8)
    words = [f"word{c}{d}" for c in "abcdefgh" for d in "abcdefghij"]
    prose = lambda n=12: " ".join(rng.choice(words, n))
    texts = [f"{prose()} reach me at x{i}@mail.org {prose()}" for i in range(9)] + [f"{prose()} at {prose()}" for _ in range(400)]
    texts += [f"{prose()} Zorro {prose()} call +1 202 555 0123 now {prose()}" for _ in range(60)] + [f"{prose()} zorro's" for _ in range(3)]
    texts += [f"{prose()} zorro rides" for _ in range(2)] + [prose(30) for _ in range(5000)] + ["only once a0@b.org"] + [texts[0]] * 40
    want = plain_disclosures(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parsed = privacy.parsed_texts(docs.select(F.struct("doc_id", "text").alias("row")))
    got = {(r["level"], r["entity"], r["term"]): r["disclosure"] for r in privacy.disclosing_terms(parsed).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert ("kind", "email", "reach") in got and ("kind", "phone", "zorro") in got and ("kind", "email", "at") not in got
    assert ("value", "phone:+1 202 555 0123", "call") in got and not any(k[2] in ("only", "once") for k in got)
    rows = privacy.find_private(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        hidden = {(text[s["start"] : s["end"]], s["kind"]) for s in r["spans"] if s["order"] >= len(privacy.KINDS)}
        kinds = {s["kind"] for s in r["base"]}
        label = lambda share: "removed" if share >= privacy.REMOVE_AT else "term"
        terms = {}
        for (level, entity, term), share in want.items():
            if level == "value" or entity in kinds:
                terms[term] = max(share, terms.get(term, 0))
        assert hidden == {(m, label(terms[m.lower()])) for m in re.findall(r"[\w'’-]+", text) if m.lower() in terms}


def test_texts_with_very_many_matches(spark):
    import time

    texts = [
        " ".join(f"u{i}@x.org" for i in range(100_000)), "1.2.3.4 " * 30_000, "1." * 100_000, "+1 202 555 0123, " * 10_000,
        "4111111111111111 " * 10_000 + "😀" * 5000 + " a@b.cc", "a" * 600 + "😀" * 700 + " a@b.cc " + "é" * 1500 + "1.2.3.4",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    start = time.time()
    rows = {r["doc_id"]: r for r in privacy.find_private(docs).collect()}
    assert time.time() - start < 120
    for i, text in enumerate(texts):
        spans = plain_spans(text)
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in rows[i]["base"]) == spans
        parts, at = [], 0
        for span in filter(None, spans.split(",")):
            kind, a, b = span.split(":")
            if int(a) >= at:
                parts += [text[at : int(a)], f"<{kind.upper()}>"]
            at = max(at, int(b))
        assert rows[i]["sanitised"] == "".join([*parts, text[at:]])


def test_privacy_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = privacy.find_private(edge_docs).select("doc_id", privacy.span_list("base").alias("s")).collect()
    assert sorted(r["s"] for r in rows) == sorted(plain_spans(r[1]) for r in edge_rows)
    clean = privacy.sanitise(edge_docs)
    assert clean.columns == edge_docs.columns and clean.count() == len(edge_rows)
    assert clean.filter("text is null").count() == 2
    assert privacy.find_private(no_docs).collect() == [] and privacy.sanitise(no_docs).collect() == []


def check_mix(rows, weights: dict[str, float]):
    """Until a stream ends it is less than one block from its exact share after any number of slots; slots are taken once."""
    total = sum(map(Fraction, weights.values()))
    shares = {s: Fraction(w) / total for s, w in weights.items()}
    slots = sorted({(r["slot"], r["stream"]) for r in rows})
    assert len({s for s, _ in slots}) == len(slots)
    of = {}
    for slot, stream in slots:
        of.setdefault(stream, []).append(slot)
    for stream, own in of.items():
        for k, slot in enumerate(own):  # k blocks before this slot, one more after it
            assert -1 < k - slot * shares[stream] and (k + 1) - (slot + 1) * shares[stream] < 1


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(alphabet="abcdef", min_size=1, max_size=2), st.tuples(st.floats(0.0001, 50), st.integers(0, 60)), min_size=1, max_size=12))
def test_schedule_keeps_within_one_block(streams):
    weights, blocks = {s: w for s, (w, _) in streams.items()}, {s: n for s, (_, n) in streams.items()}
    plan = mixing.schedule(weights, blocks)
    assert Counter(s for s, _, _ in plan) == Counter({s: n for s, n in blocks.items() if n})
    total = sum(map(Fraction, weights.values()))
    for stream, block, slot in plan:
        step = total / Fraction(weights[stream])
        assert math.floor(block * step) <= slot < math.ceil((block + 1) * step)
    check_mix([{"slot": slot, "stream": s} for s, _, slot in plan], weights)


def test_odd_weights_are_exact(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id < 2 THEN 'tiny' WHEN id < 1400 THEN 'third' ELSE 'most' END AS source")
    weights = {"tiny": 0.0003, "third": 1 / 3, "most": 1 - 1 / 3 - 0.0003}
    rows = mixing.mix(docs, weights, block_rows=1).collect()
    assert len(rows) == 3000 and "<rest>" not in {r["stream"] for r in rows}
    check_mix(rows, weights)
    assert sorted(r["slot"] for r in rows if r["stream"] == "tiny")[1] >= 3333


def test_every_source_is_a_stream(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('s', id % 400) AS source")
    rows = mixing.mix(docs, block_rows=4).collect()
    assert len({r["stream"] for r in rows}) == 400 and len(rows) == 40_000
    check_mix(rows, {f"s{i}": 100 for i in range(400)})


def test_sources_that_share_a_stream_keep_their_pace(spark):
    """Two named sources, forty in the shared stream with their own weights; nothing is lost and blocks grow to their bound."""
    docs = spark.range(9000).selectExpr("id AS doc_id", "CASE WHEN id < 4000 THEN 'a' WHEN id < 7000 THEN 'b' ELSE concat('c', floor(sqrt(id - 7000))) END AS source")
    rows = mixing.mix(docs, named=2, temperature=0.5, block_rows=3).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(9000)) and {r["stream"] for r in rows} == {"a", "b", "<rest>"}
    counts = Counter(r["source"] for r in rows)
    check_mix(rows, {"a": 4000**0.5, "b": 3000**0.5, "<rest>": sum(n**0.5 for s, n in counts.items() if s not in "ab")})
    order = [r["source"] for r in sorted((r for r in rows if r["stream"] == "<rest>"), key=lambda r: (r["slot"], r["place"]))]
    seen = Counter()
    for at, source in enumerate(order):
        seen[source] += 1
        if at % 97 == 0:
            now = max(k / counts[s] ** 0.5 for s, k in seen.items())
            assert all(counts[s] == k or abs(k - now * counts[s] ** 0.5) <= 1.001 for s, k in seen.items())
    few = mixing.mix(docs, block_rows=1, most_blocks=90).collect()
    assert len({r["slot"] for r in few}) <= 90 + 45 and max(r["place"] for r in few) == 99


def test_blocks_have_the_same_size_on_every_input(spark):
    """Over 200,000 blocks of one row, a schedule stored in several pieces: no block grows, and slots are those of the whole schedule."""
    docs = spark.range(210_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', 'b') AS source")
    rows = mixing.mix(docs, {"a": 1.0, "b": 2.0}, block_rows=1).select("stream", "block", "slot", "place").collect()
    assert len(rows) == 210_000 and max(r["place"] for r in rows) == 0
    assert {(r["stream"], r["block"], r["slot"]) for r in rows} == set(mixing.schedule({"a": 1.0, "b": 2.0}, {"a": 70_000, "b": 140_000}))


def test_op2_mixes_every_document_once(spark, documents):
    rows = queries.op2_pfair_mixing(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == [d[0] for d in documents]
    assert {r["doc_id"]: r["source"] for r in rows} == {d[0]: d[3] for d in documents}
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    for stream in {r["stream"] for r in rows}:
        own = sorted((r["slot"], r["place"], r["block"]) for r in rows if r["stream"] == stream)
        assert [b * 16 + p for _, p, b in own] == list(range(len(own)))
    counts = Counter(d[3] for d in documents)
    weights = {s: n**0.7 for s, n in counts.items()}
    check_mix(rows, weights)
    plan = {(s, k): slot for s, k, slot in mixing.schedule(weights, {s: -(-n // 16) for s, n in counts.items()})}
    assert all(plan[r["stream"], r["block"]] == r["slot"] for r in rows)


def test_mix_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = mixing.mix(edge_docs, {"a": 2.0, "<null>": 1.0, "none": 3.0}, block_rows=1).collect()
    assert Counter(r["stream"] for r in rows) == Counter("<rest>" if r[3] == "b" else r[3] or "<null>" for r in edge_rows)
    check_mix(rows, {"a": 2.0, "<null>": 1.0, "none": 3.0, "<rest>": 0.006})
    assert len(mixing.mix(edge_docs, {}).collect()) == len(mixing.mix(edge_docs, named=0).collect()) == len(edge_rows)
    out = mixing.mixed(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(edge_rows)
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_pipeline_stages_and_run(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    good = corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    verdicts = {r["doc_id"] for r in queries.op10_quality_rules(spark, SF_DIR).filter("kept").collect()}
    assert good.columns == names and {r["doc_id"] for r in good.collect()} == verdicts
    kept = [d for d in documents if d[0] in verdicts]
    least = set(plain_components([(d[0], plain_print(d[1])) for d in kept]).values())
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == least
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "source mix", "best-fit packing"]
    clean = corpus_pipeline.personal_data(spark, good, SF_DIR)
    mixed = corpus_pipeline.source_mix(spark, clean, SF_DIR)
    assert clean.columns == mixed.columns == names
    assert not [r for r in mixed.collect() if plain_spans(r["text"])]


def test_sequences_follow_the_mix(spark):
    """Documents of one source after the other, by id; a sequence holds four of them."""
    counts = {"hot": 1600, "mid": 320, "low": 80}
    sources = [s for s, n in counts.items() for _ in range(n)]
    rows = [(i, "a " * (490 + i % 3), source) for i, source in enumerate(sources)]
    rows.append((5000, "a " * 5000, "low"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    packed = corpus_pipeline.sequences(spark, docs, SF_DIR).collect()
    assert sorted({r["doc_id"] for r in packed}) == [r[0] for r in rows]
    assert {len(r["ids"]) for r in packed if r["doc_id"] == 5000} == {4 * 2048, 4 * (5001 - 2 * 2048)}
    ends = Counter()
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]] and len(r["ids"]) == 4 * r["length"]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048 and set(ends) == set(range(len(ends)))
    mix = {r["doc_id"]: (r["slot"], r["place"]) for r in mixing.mix(docs, temperature=corpus_pipeline.TEMPERATURE).collect()}
    first = {}
    for r in packed:
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], (1 << 40,)), (*mix[r["doc_id"]], r["piece"]))
    assert [first[i] for i in range(len(first))] == sorted(first.values())
    weights = {s: n**0.7 for s, n in counts.items()}
    for upto in (60, 90):  # sequences, while no source has ended
        seen = Counter(sources[r["doc_id"]] for r in packed if r["sequence_id"] < upto and r["doc_id"] < 5000)
        for source, weight in weights.items():
            assert abs(seen[source] / seen.total() - weight / sum(weights.values())) < 0.1
