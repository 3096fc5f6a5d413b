"""Quality rules (op11) and the divergence audit (op13) against brute force, with nulls, empties and repeats."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from catalogflow.llm import divergence, quality_rules

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] >= 2 for k in range(3)}
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    n = len(words)
    return (n, sum(len(w) for w in words), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_quality_measures_against_brute_force(spark):
    texts = [None, "", "   \n\t ", "a b c a b c a b c", "x " * 60, "w1 w2 w3 w4 " * 20 + "tail",
             "\n".join(["same line here"] * 5 + [f"line {i} with words" for i in range(30)]),
             " ".join(f"word{i}" for i in range(80)) + " #$% <b> & | *", "é ü 漢字 " * 30, "z" * 5000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(0, texts[0], "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n_words int")
    out = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.quality_rules(docs).collect()}
    assert out == {(i, *brute_measures(t)) for i, t in enumerate(texts)}
    got = quality_rules.quality_rules(docs).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.base_failed)


def test_quality_cascade_order_keeps_verdicts(spark):
    texts = [" ".join(f"word{i % 70}" for i in range(200)), "... \n" * 80, "- item\n" * 100,
             " ".join("12345" for _ in range(100)), " ".join(f"w{i}#" for i in range(100))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = quality_rules.measures(docs)
    verdicts = []
    for order in (quality_rules.RULES, tuple(reversed(quality_rules.RULES))):
        kept, _ = quality_rules.cascade(order)
        verdicts.append(sorted((r.doc_id, r.k) for r in measured.select("doc_id", kept.alias("k")).collect()))
    assert verdicts[0] == verdicts[1]
    assert [e.rule.name for e in quality_rules.estimate(docs)] != []


def test_quality_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.quality_rules(docs).count() == 0


def brute_audit(rows, min_documents=3, top=200):
    docs = [((l or ""), (s or ""), [m.group(0) for m in re.finditer(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c.group(0).lower(), t or ""))])
            for t, l, s in rows]
    df = defaultdict(Counter)
    counts = defaultdict(Counter)
    for l, s, ts in docs:
        df[l].update(set(ts))
        counts[(l, s)].update(ts)
    vocab = {l: sorted(t for t, c in df[l].items() if c >= min_documents) for l in df}
    groups = sorted({(l, s) for l, s, _ in docs})

    def p_of(counter, v):
        n = sum(counter[t] for t in v)
        return {t: 1 + 10**9 * (counter[t] + 1) // (n + len(v)) for t in v}

    lang_counts = defaultdict(Counter)
    for (l, s), c in counts.items():
        lang_counts[l].update(c)
    out = []
    for l, s in groups:
        v = vocab[l]
        p = p_of(counts[(l, s)], v)
        pairs = []
        for l2, s2 in groups:
            if l2 == l and s2 != s:
                q = p_of(counts[(l2, s2)], v)
                pairs.append((s2, sum((p[t] - q[t]) ** 2 // q[t] for t in v)))
        q = p_of(lang_counts[l], v)
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in v if counts[(l, s)][t] > 0 and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for r, (item, value) in enumerate(items, 1):
                if part == "pair" or r <= top:
                    out.append((l, s, part, item, value, r))
    return sorted(out)


def test_audit_against_brute_force(spark):
    words = ["alpha", "Beta", "gamma", "delta", "épée", "ZETA", "eta", "theta"]
    rows = []
    for i in range(60):
        text = " ".join(words[(i * k) % len(words)] for k in range(1, 2 + i % 7)) + f" x{i} 42 a-b"
        rows.append((text, ["en", "fr", None][i % 3], [f"s{i % 4}", None, "s1"][i % 3]))
    rows += [(None, "en", "lonely"), ("", "de", "s0"), (rows[0][0], rows[0][1], rows[0][2])]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("item", F.col("text"))
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == brute_audit(rows)


def test_audit_small_top_and_empty(spark):
    rows = [(" ".join(f"t{chr(97 + j)}" for j in range(i % 9)), "en", f"s{i % 2}") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.audit(docs, top_terms=2, salts=3).collect())
    assert got == brute_audit(rows, top=2)
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(empty).count() == 0


def test_audit_shuffles_terms_once(spark):
    """Run classes and counts stay where the terms were dealt: before, 59 exchanges carried them again and again."""
    rows = [(f"a b c {chr(97 + i % 20)}x é", "en", f"s{i % 5}") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    audit = divergence.audit(docs)
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Exchange hashpartitioning") <= 12
    assert sorted(tuple(r) for r in audit.collect()) == brute_audit(rows)


def test_audit_term_counts_handed_on_in_pieces(spark):
    texts = ["B a b A", "", "\x00é É\u00a0x\u2003y[z", "a " * 50 + "c", "a1b\tc"]
    rows = [("en", "s", t) for t in texts] * 3 + [("fr", "", "a"), ("en", "t", "c")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(2)
    found = defaultdict(lambda: [0, 0])
    for lang, source, text in rows:
        got = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c.group(0).lower(), text))
        for term, n in Counter(got).items():
            found[lang, source, term][0] += n
            found[lang, source, term][1] += 1
    for held in (1, 4, 1000):
        got = divergence.term_counts(docs, held).collect()
        assert {(r.lang, r.source, r.term): [r.c, r.documents] for r in got} == found and len(got) == len(found)


def test_audit_frequency_of_any_count(spark):
    cases = [(0, 1, 1), (5, 10, 7), (9223372034, 10**12, 3), (9223372035, 10**12, 3), (9223372036, 10**13, 10**6), (10**15, 10**17, 5)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = df.select("c", "n", "v", divergence.smoothed(F.col("c"), F.col("n"), F.col("v")).cast("long").alias("p")).collect()
    assert sorted(tuple(r) for r in got) == [(c, n, v, 1 + 10**9 * (c + 1) // (n + v)) for c, n, v in cases]
