"""SQL for the corpus queries that SQL can express; DuckDB runs it on the same tables.

None for SimHash (no XXH64), tokens (no tokenizer), and everything a model scores; their
tests compare with plain Python, whole encodings or held-out labels.
"""

from tachyline.llm import decontamination, divergence, merkle, secret_scan, vector_codes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _node(children: str) -> str:
    return f"sha256(array_to_string({children}, ''))"


_SHORT = merkle.SHORT
_PARAGRAPHS = f"list_transform(section, lambda pieces: {_node('pieces')})"
_ROOT = _node(f"list_transform(tree, lambda section: {_node(_PARAGRAPHS)})")
_PARAGRAPH = f"array_to_string(list_concat([left({_node('pieces')}, {_SHORT})], list_transform(pieces, lambda d: left(d, {_SHORT}))), '.')"
_SECTION = f"array_to_string(list_concat([left({_node(_PARAGRAPHS)}, {_SHORT})], list_transform(section, lambda pieces: {_PARAGRAPH})), ',')"


def _tree(text: str) -> str:
    cut = merkle.PIECE
    pieces = f"list_transform(range(0, (greatest(length(p), 1) - 1) // {cut} + 1), lambda i: sha256(substr(p, i * {cut} + 1, {cut})))"
    return f"list_transform(string_split_regex({text}, '\\n[ \\t]*\\n'), lambda s: list_transform(string_split(s, chr(10)), lambda p: {pieces}))"


def _fingerprint(tree: str) -> str:
    body = f"array_to_string(list_concat([{_ROOT}], list_transform(tree, lambda section: {_SECTION})), ';')"
    return f"(SELECT {body} FROM (SELECT {tree} AS tree))"


def _leaves(tree: str) -> str:
    return f"list_distinct(list_transform(flatten(flatten({tree})), lambda d: left(d, {_SHORT})))"


def _dice(one: str, other: str) -> str:
    return f"CAST(2 * len(list_intersect({one}, {other})) AS DOUBLE) / (len({one}) + len({other}))"


MERKLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
met AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM texts),
edits AS (
    SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM met),
trees AS (
    SELECT *, {_tree("text")} AS own_tree, {_tree("edited")} AS edited_tree, {_tree("next_text")} AS next_tree FROM edits),
sets AS (
    SELECT *, {_leaves("own_tree")} AS own, {_leaves("edited_tree")} AS changed, {_leaves("next_tree")} AS following FROM trees)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, {_fingerprint("own_tree")} AS fingerprint,
       {_fingerprint("edited_tree")} AS edited_fingerprint, {_dice("own", "changed")} AS near_edited, {_dice("own", "following")} AS near_next
FROM sets"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, group: int = 0, least: int = 0) -> str:
    pattern = _quoted(pattern.replace(r"\x20", " "))
    return f"""
    SELECT doc_id, text, {kind} AS kind, hits[i] AS hit,
           CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda h: length(h))), 0) AS BIGINT) AS start_
    FROM (SELECT doc_id, text, string_split_regex(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}) AS hits,
                 regexp_extract_all(text, {pattern}, {group}) AS found FROM texts WHERE regexp_matches(text, {pattern})),
         LATERAL unnest(range(1, len(hits) + 1)) AS places(i)
    WHERE length(found[i]) >= {least}"""


_CLASS = " ".join(f"WHEN regexp_full_match(hit, {_quoted(p)}) THEN {{}}" for p, _, _ in secret_scan.CLASSES)
_WIDTH = "CASE " + _CLASS.format(*(w for _, w, _ in secret_scan.CLASSES)) + " END"
_LEAST = "CASE " + _CLASS.format(*(h for _, _, h in secret_scan.CLASSES)) + " END"
_ALLOWED = " OR ".join(f"regexp_matches(hit, {_quoted(a)})" for a in secret_scan.ALLOWED)
_WRITTEN = "coalesce(string_agg(['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start_ || ':' || end_, ',' ORDER BY start_, kind){}, '')"
SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (
    SELECT doc_id, kind, start_, start_ + length(hit) AS end_ FROM (
    {_matches(0, secret_scan.ASSIGN, 2, secret_scan.LEAST_VALUE)}
    UNION ALL {_matches(1, secret_scan.ACCESS)}
    UNION ALL {_matches(2, secret_scan.HEX)})),
candidates AS (
    SELECT doc_id, hit, start_, {_WIDTH} AS width, {_LEAST} AS least FROM ({_matches(3, secret_scan.CANDIDATE)})
    WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT ({_ALLOWED})),
windows AS (
    SELECT doc_id, start_, hit, width, least, first_, string_split(substr(hit, first_, width), '') AS signs
    FROM candidates, LATERAL unnest(range(1, length(hit) - width + 2)) AS places(first_)),
hot AS (
    SELECT doc_id, 3 AS kind, start_ + min(first_) - 1 AS start_, start_ + max(first_) - 1 + any_value(width) AS end_ FROM windows
    WHERE log2(width) - list_sum(list_transform(list_distinct(signs),
              lambda s: len(list_filter(signs, lambda t: t = s)) * log2(len(list_filter(signs, lambda t: t = s))))) / width >= least
    GROUP BY doc_id, windows.start_, hit),
spans AS (
    SELECT * FROM base UNION ALL
    SELECT * FROM hot WHERE NOT EXISTS (
        SELECT 1 FROM base WHERE base.doc_id = hot.doc_id AND base.start_ <= hot.start_ AND hot.end_ <= base.end_))
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex, sha256({_WRITTEN.format(" FILTER (WHERE kind < 3)")}) AS base_sha256,
       {_WRITTEN.format(" FILTER (WHERE kind IS NOT NULL)")} AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


def _words(table: str) -> str:
    return rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table}"


_SIZE = decontamination.WINDOW_WORDS
BENCHMARK_HITS = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words("benchmark")}),
item_windows AS (
    SELECT DISTINCT item_id, least({_SIZE}, len(words)) AS size, array_to_string(words[i:i + least({_SIZE}, len(words)) - 1], ' ') AS window_
    FROM items, LATERAL unnest(range(1, greatest(len(words) - {_SIZE - 1}, 1) + 1)) AS places(i) WHERE len(words) > 0),
docs AS (SELECT doc_id, {_words("documents")}),
doc_windows AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS window_
    FROM docs, (SELECT DISTINCT size FROM item_windows), LATERAL unnest(range(1, len(words) - size + 2)) AS places(i)),
found AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, window_)),
hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM found, LATERAL unnest(range(i, i + size)) AS places(word) GROUP BY doc_id),
names AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_SHARE = f"1 + ({divergence.UNIT}::HUGEINT * ({{}} + {divergence.PRIOR})) // ({{}} + {divergence.PRIOR} * size)"
SOURCES = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS terms FROM documents),
words AS MATERIALIZED (SELECT number, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT number) >= {divergence.LEAST_DOCS}),
langs AS (
    SELECT lang, count(term) AS size, coalesce(sum(lang_n), 0) AS lang_total
    FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups_ AS MATERIALIZED (
    SELECT lang, source, size, lang_total, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs)
    JOIN langs USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS MATERIALIZED (
    SELECT lang, source, term, coalesce(n, 0) AS n, {_SHARE.format("coalesce(n, 0)", "total")} AS p, {_SHARE.format("lang_n", "lang_total")} AS q
    FROM groups_ JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
sums AS (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
found AS (
    SELECT * FROM pairs UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def _assigned(step: int) -> str:
    """Each part's nearest entry after ``step`` rounds: the distance and the entry in one number."""
    distance = "list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e)"
    return f"""
near{step} AS MATERIALIZED (
    SELECT place, part, any_value(x) AS x, min(CAST({distance} AS BIGINT) * {vector_codes.ENTRIES} + entry) AS best
    FROM cut JOIN book{step} USING (part) GROUP BY place, part)"""


def _moved(step: int) -> str:
    """The entries after the next round: floors of means, or the old ones where nothing was assigned."""
    return f"""
sums{step} AS (
    SELECT part, best % {vector_codes.ENTRIES} AS entry, spot, CAST(sum(x[spot]) AS BIGINT) AS total, count(*) AS n
    FROM near{step}, LATERAL unnest(range(1, len(x) + 1)) AS places(spot) GROUP BY ALL),
means{step} AS (
    SELECT part, entry, list(CAST((total - (total % n + n) % n) // n AS DOUBLE) ORDER BY spot) AS e FROM sums{step} GROUP BY part, entry),
book{step + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{step} b LEFT JOIN means{step} m USING (part, entry))"""


_STEPS = ",".join(f"{_assigned(step)},{_moved(step)}" for step in range(vector_codes.ROUNDS)) + f",{_assigned(vector_codes.ROUNDS)}"
CODED = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, label,
           list_transform(embedding, lambda x: floor({vector_codes.SCALE} * CAST(x AS DOUBLE))) AS whole
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
    SELECT place, part, whole[part * len(whole) // {vector_codes.PARTS} + 1:(part + 1) * len(whole) // {vector_codes.PARTS}] AS x
    FROM kept, LATERAL unnest(range({vector_codes.PARTS})) AS parts(part)),
book0 AS MATERIALIZED (SELECT part, place - 1 AS entry, x AS e FROM cut WHERE place <= {vector_codes.ENTRIES}),{_STEPS},
codes AS (
    SELECT place, string_agg(format('{{:02x}}', best % {vector_codes.ENTRIES}), '' ORDER BY part) AS code, CAST(sum(best // {vector_codes.ENTRIES}) AS BIGINT) AS error
    FROM near{vector_codes.ROUNDS} GROUP BY place),
books AS (
    SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book{vector_codes.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (place), books"""

ORACLE_SQL = {
    "op2_merkle": MERKLE,
    "op3_secret_scan": SECRETS,
    "op10_decontamination": BENCHMARK_HITS,
    "op11_divergence": SOURCES,
    "op12_vector_codes": CODED,
}
