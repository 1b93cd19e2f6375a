"""DuckDB SQL of the queries that SQL can express, written from the operators' definitions."""

from __future__ import annotations

from aerolake.llm.license_scan import THRESHOLD, template_cells
from aerolake.llm.quality_rules import BASE, CURRENT, POLICIES, RULES
from aerolake.llm.sharding import LCG_MULTIPLIER
from aerolake.llm.url_filter import HOST_RULES, MIN_CONFIDENCE, MIN_COUNT, MIN_SUPPORT

_BIT = {r.name: i for i, r in enumerate(RULES)}

# Words, lines and repeated 5-word windows of every whole text.
_MEASURED = r"""
w AS (SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, sum(least(5, nxt - i)) AS n_repeat_words
        FROM (SELECT doc_id, i, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) AS nxt FROM dup)
        GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
             length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')))::BIGINT AS n_upper,
             (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclamations,
             (length(t) - length(regexp_replace(t, '[0-9]', '', 'g')))::BIGINT AS n_digits
      FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id))"""


def _failed(names) -> str:
    return "(" + " OR ".join(f"({r.fails})" for r in RULES if r.name in names) + ")"


def _op2() -> str:
    """The exact definition: aligned windows by weighted shingle similarity, without fingerprints."""
    return r"""WITH
d AS (SELECT row_number() OVER () AS r, * FROM (
        SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents)),
b AS (SELECT row_number() OVER () AS q, * FROM (
        SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark)),
ds AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
bs AS (SELECT q, j, n, array_to_string(ws[j:j + 4], ' ') AS s
       FROM (SELECT *, len(ws) AS n, unnest(range(1, len(ws) - 3)) AS j FROM b WHERE len(ws) >= 5)),
bw AS (SELECT q, sum(length(s)) AS w FROM (SELECT DISTINCT q, s FROM bs) GROUP BY q),
win AS (SELECT DISTINCT r, n, i - j AS first FROM ds JOIN bs USING (s)),
ws AS (SELECT DISTINCT r, n, first, s FROM win JOIN ds USING (r)
       WHERE i > first AND i + 4 <= first + n),
ww AS (SELECT r, n, first, sum(length(s)) AS w FROM ws GROUP BY ALL),
common AS (SELECT r, n, first, q, sum(length(s)) AS c
           FROM ws JOIN (SELECT DISTINCT q, n, s FROM bs) USING (n, s) GROUP BY ALL),
hits AS (SELECT r, q, c::DOUBLE / (ww.w + bw.w - c) AS similarity
         FROM common JOIN ww USING (r, n, first) JOIN bw USING (q)
         WHERE c::DOUBLE / (ww.w + bw.w - c) >= 0.8
         UNION ALL
         SELECT r, q, 1::DOUBLE FROM d JOIN b USING (ws) WHERE len(ws) BETWEEN 1 AND 4)
SELECT doc_id, item_id, max(similarity) AS similarity
FROM hits JOIN d USING (r) JOIN b USING (q) GROUP BY doc_id, item_id"""


def _op3() -> str:
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
    return f"""WITH {_MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_failed(BASE)} AS base_failed, NOT {_failed(BASE)} AND NOT {_failed(POLICIES[CURRENT])} AS kept,
       ({bits})::BIGINT AS fail_bits, {CURRENT}::INTEGER AS policy
FROM m"""


def _ablation() -> str:
    parts = []
    for version, names in sorted(POLICIES.items()):
        for name in names:
            mine = _failed([name])
            rest = [n for n in names if n != name]
            others = _failed(rest) if rest else "false"
            parts.append(f"""SELECT {version} AS policy, '{name}' AS rule,
  count(*) FILTER (WHERE {mine}) AS n_failed, count(*) FILTER (WHERE {mine} AND NOT {others}) AS n_only,
  count(*) FILTER (WHERE NOT {mine} AND NOT {others}) AS n_kept,
  count(*) FILTER (WHERE NOT {others}) AS n_kept_without FROM m""")
    return f"WITH {_MEASURED}\n" + "\nUNION ALL ".join(parts)


def _jump(shards: int) -> str:
    """The jumps of every document as recursive rows; the shard is the last bucket below ``shards``."""
    return f"""
j{shards}(doc_id, b, j, k) AS (
  SELECT doc_id, -1::BIGINT, 0::BIGINT, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616
                                             ELSE coalesce(doc_id, 0)::HUGEINT END FROM documents
  UNION ALL
  SELECT doc_id, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((n // 8589934592) + 1)::DOUBLE))::BIGINT, n
  FROM (SELECT doc_id, j, (k * {LCG_MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT AS n
        FROM j{shards} WHERE j < {shards})),
s{shards} AS (SELECT doc_id, max(b)::INTEGER AS shard FROM j{shards} GROUP BY doc_id)"""


# CRC-32 of the UTF-8 bytes, byte by byte over a table made from the polynomial.
_CRC = """
steps AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, range(8)::UBIGINT[]),
  lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS tab),
crc AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
  xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode(coalesce(text, '')))),
        lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::UBIGINT)),
      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM documents, steps)"""


def _op7() -> str:
    return f"""WITH RECURSIVE {_jump(16)}, {_jump(17)}, {_CRC}
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, s16.shard AS shard,
       (row_number() OVER (PARTITION BY s16.shard ORDER BY doc_id) - 1)::BIGINT AS slot, s17.shard AS grown_shard
FROM crc JOIN s16 USING (doc_id) JOIN s17 USING (doc_id)"""


def _op4() -> str:
    rows = ", ".join("({}, '{}', '{}', {})".format(i, lic, g.replace("'", "''"), c)
                     for i, lic, grams in template_cells() for g, c in grams)
    return f"""WITH cell(template, licence, g, c) AS (VALUES {rows}),
size AS (SELECT template, sum(c) AS n FROM cell GROUP BY template),
u AS (SELECT doc_id, 0 AS line, text AS t FROM documents WHERE contains(text, chr(10))
      UNION ALL
      SELECT doc_id, i, string_split(text, chr(10))[i]
      FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
w AS (SELECT doc_id, line, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS ws FROM u),
n AS (SELECT doc_id, line, ws, len(ws) - 1 AS n FROM w WHERE len(ws) BETWEEN 2 AND 1000),
b AS (SELECT doc_id, line, n, ws[i] || ' ' || ws[i + 1] AS g
      FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM n)),
k AS (SELECT doc_id, line, n, g, count(*) AS k FROM b GROUP BY ALL),
s AS (SELECT doc_id, line, template, licence, k.n AS n, sum(least(k, c)) AS common
      FROM k JOIN cell USING (g) GROUP BY ALL)
SELECT doc_id, line::INTEGER AS line, template, licence, 2.0::DOUBLE * common / (s.n + size.n) AS dice
FROM s JOIN size USING (template) WHERE 2.0::DOUBLE * common / (s.n + size.n) >= {THRESHOLD}"""


def _op6() -> str:
    names = sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: (f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND "  # noqa: E731
                      f"starts_with(path, '{r.path}'))")
    pick = lambda of: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{of(r)}'" for r in names) + " END"
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH
h AS (SELECT page_id, coalesce(url, '') AS url, {low("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")} AS host,
             regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
p AS (SELECT page_id, host, path, list_sort(list_distinct(
        list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h=' || x)
        || list_transform(list_filter(string_split_regex({low('path')}, '[^a-z0-9-]+'), lambda x: x <> ''),
                          lambda x: 'p=' || CASE WHEN regexp_full_match(x, '[0-9]+') THEN '#' ELSE x END)
        || list_transform(list_filter(list_transform(string_split(
             {low("regexp_extract(url, '[?]([^#]*)', 1)")}, '&'), lambda x: regexp_extract(x, '^[^=]*')),
             lambda x: x <> ''), lambda x: 'q=' || x))) AS items,
      {pick(lambda r: r.name)} AS rule, {pick(lambda r: r.verdict)} AS given FROM h),
known AS (SELECT items, given = 'block' AS bad FROM p WHERE given IS NOT NULL
          UNION ALL
          SELECT items, mark = 1 FROM p JOIN (SELECT doc_id, max(toxic) AS mark FROM labels GROUP BY doc_id) l
            ON p.page_id = l.doc_id WHERE given IS NULL AND mark IS NOT NULL),
least_n AS (SELECT ceil(greatest({MIN_SUPPORT}, {MIN_COUNT}::DOUBLE / count(*)) * count(*)) AS m,
                   count(*) AS n FROM known),
-- every combination of a URL's tokens, by the bits of a number
combos AS (SELECT bad, list_filter(items, lambda x, i: (bits >> (i - 1)) & 1 = 1) AS c
           FROM (SELECT items, bad, unnest(range(1, (1 << len(items))::BIGINT)) AS bits FROM known)),
freq AS (SELECT c, count(*) AS n, count(*) FILTER (WHERE bad) AS nb FROM combos GROUP BY c),
rules AS (SELECT c, nb::DOUBLE / freq.n AS confidence, nb::DOUBLE / least_n.n AS support
          FROM freq, least_n WHERE nb >= m AND nb::DOUBLE / freq.n >= {MIN_CONFIDENCE}),
kept AS (SELECT * FROM rules r WHERE NOT EXISTS (
           SELECT 1 FROM rules q WHERE len(q.c) < len(r.c) AND q.confidence >= r.confidence
                                   AND list_has_all(r.c, q.c))),
best AS (SELECT s.items, kept.c, kept.confidence FROM (SELECT DISTINCT items FROM p) s
         JOIN kept ON list_has_all(s.items, kept.c)
         QUALIFY row_number() OVER (PARTITION BY s.items ORDER BY kept.confidence DESC, kept.support DESC,
                                    len(kept.c), array_to_string(kept.c, ' & ')) = 1)
SELECT page_id, host, path, rule, array_to_string(best.c, ' & ') AS mined_rule,
       best.confidence AS mined_confidence,
       coalesce(given, CASE WHEN best.c IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN best USING (items)"""


def statements() -> dict[str, str]:
    return {"op2_decontamination": _op2(), "op3_quality_rules": _op3(), "quality_rule_ablation": _ablation(), "op4_license_scan": _op4(),
            "op6_url_filter": _op6(), "op7_sharding": _op7()}
