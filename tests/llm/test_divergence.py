"""Divergence between sources against plain loops over all pairs and terms."""

import random
import re

import pytest

from tachyline.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_audit(rows, least, most=50):
    docs = [(lang or "", source or "", TERM.findall(lowered(text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        with_term = {}
        for _, _, terms in own:
            for term in set(terms):
                with_term[term] = with_term.get(term, 0) + 1
        kept = sorted(t for t, n in with_term.items() if n >= least)

        def shares(found, kept=kept):
            total = sum(found.get(t, 0) for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (found.get(t, 0) + 5) // total for t in kept}

        counts, whole = {}, {}
        for _, source, terms in own:
            group = counts.setdefault(source, {})
            for term in terms:
                group[term] = group.get(term, 0) + 1
                whole[term] = whole.get(term, 0) + 1
        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for one in counts:
            found = [("pair", other, sum(abs(p[one][t] - p[other][t]) for t in kept)) for other in counts if other != one]
            found += [("term", t, p[one][t] - q[t]) for t in kept if counts[one].get(t) and p[one][t] > q[t]]
            for part in ("pair", "term"):
                ordered = sorted((-v, item.encode(), item) for kind, item, v in found if kind == part)
                limit = most if part == "term" else None
                out += [(lang, one, part, item, -v, rank) for rank, (v, _, item) in enumerate(ordered[:limit], 1)]
    return sorted(out)


def got(spark, rows, **how):
    frame = divergence.audit(spark.createDataFrame(rows, SCHEMA), **how)
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize(("group_block", "term_block"), [(64, 1024), (3, 5)])
def test_many_cells_equal_plain_loops(spark, group_block, term_block):
    rng = random.Random(group_block)
    words = [*"abcdefghij", "Straße", "ÄÖ", "漢字", "ab'cd", "x1y", "🙂", "Zug", "zug"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(12)))
        rows.append((i, rng.choice([text, text, text.upper()]), rng.choice(["de", "en", None]), rng.choice([f"s{rng.randrange(14)}", None, "hot", "hot"])))
    rows += [(900, None, "de", "empty"), (901, "", "xx", "one"), (902, "never kept", "xx", "two"), (902, "never kept", "xx", "two"), (903, "alone", "yy", "only")]
    want = plain_audit(rows, least=5)
    assert got(spark, rows, least_docs=5, group_block=group_block, term_block=term_block) == want
    assert ("xx", "one", "pair", "two", 0, 1) in want


def test_ties_and_limit(spark):
    rows = [(i, f"w{j:02d} é{chr(97 + j)}", "en", f"s{i % 2}") for i, j in enumerate(list(range(26)) * 4)]
    assert got(spark, rows, least_docs=2, most_terms=3) == plain_audit(rows, 2, most=3)


def test_long_text_extra_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "wort " * 200_000 + "x" * 300_000, "de", "a", 1, "q"), (2, "wort", "de", "b", 2, "p")], SCHEMA + ", n int, kept string")
    found = {tuple(r) for r in divergence.audit(frame, least_docs=1).collect()}
    assert found == set(plain_audit([tuple(r)[:4] for r in frame.collect()], 1))
    assert divergence.audit(frame.limit(0)).count() == 0


def test_shares_are_exact_for_huge_counts(spark):
    row = spark.range(1).select(divergence.share(divergence.F.lit(4 * 10**18), divergence.F.lit(8 * 10**18 + 3)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (4 * 10**18 + 5) // (8 * 10**18 + 3)
