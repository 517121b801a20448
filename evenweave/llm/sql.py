"""SQL that gives the same rows as the queries of this subpackage, for DuckDB."""

from __future__ import annotations

from evenweave.llm import pii

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

# The base rules as stated, without the anchors that only save time.
_RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": pii.PATTERNS["iban"],
    "ssn": pii.PATTERNS["ssn"],
    "secret": r"[A-Za-z0-9+/_-]{20,}={0,2}",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: "
    f"CASE WHEN i % 2 = 1 THEN reverse({_DIGITS})[i]::INT "
    f"WHEN reverse({_DIGITS})[i]::INT > 4 THEN reverse({_DIGITS})[i]::INT * 2 - 9 "
    f"ELSE reverse({_DIGITS})[i]::INT * 2 END)) % 10 = 0"
)
_BARE = "replace(m, ' ', '')"
_MOD_97 = (
    f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({_BARE}[5:] || {_BARE}[1:4], ''), "
    "lambda c: ascii(c)::BIGINT)), lambda a, c: CASE WHEN c < 58 THEN a * 10 + c - 48 ELSE a * 100 + c - 55 END % 97) = 1"
)
# Of an IBAN in groups the longest start that passes.
_GROUPS = "string_split(m, ' ')"
_IBAN_LENGTH = (
    f"length(list_filter(list_transform(range(length({_GROUPS}), least(length({_GROUPS}), 3) - 1, -1), "
    f"lambda k: array_to_string({_GROUPS}[1:k], ' ')), lambda p: {_MOD_97.replace('m,', 'p,')})[1])"
)
_VALID = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) < 4 "
          "AND coalesce(TRY_CAST(p AS INT), 0) <= 255))",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
    "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND list_sum(list_transform("
              "list_distinct(string_split(m, '')), lambda c: -(length(m) - length(replace(m, c, ''))) / length(m)::DOUBLE "
              f"* log2((length(m) - length(replace(m, c, ''))) / length(m)::DOUBLE))) >= {pii.LEAST_ENTROPY}",
    "ssn": "m[1:3] NOT IN ('000', '666') AND m[1:3] < '900' AND m[5:6] <> '00' AND m[8:] <> '0000'",
}


def _kind_sql(kind: str) -> str:
    rule = _RULES[kind].replace("(?:", "(").replace("'", "''")
    words = "|".join(pii.CONTEXT_WORDS[kind])
    start_score = pii.START[kind] + pii.CHECKSUM_GAIN.get(kind, 0.0)
    before = f"lower(t[greatest(s - {pii.CONTEXT}, 0) + 1 : s])"
    score = f"{start_score} + CASE WHEN regexp_matches({before}, '\\b({words})\\b') THEN {pii.CONTEXT_GAIN} ELSE 0 END"
    length = _IBAN_LENGTH if kind == "iban" else "length(m)"
    valid = f"{_IBAN_LENGTH} IS NOT NULL" if kind == "iban" else _VALID[kind]
    keep = "true" if kind in pii.BASE_KINDS else f"{score} >= {pii.THRESHOLD}"
    return f"""
    SELECT doc_id, s, {pii.KINDS.index(kind)} AS ord, s + {length} AS e, '{kind}' AS kind FROM (
      SELECT doc_id, t, ms[i] AS m,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) +
        coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
      FROM (SELECT *, unnest(range(1, length(ms) + 1)) AS i FROM (
        SELECT doc_id, t, regexp_extract_all(t, '{rule}') AS ms, string_split_regex(t, '{rule}') AS gaps FROM d))
    ) WHERE ({valid}) AND {keep}"""


def op1_sql() -> str:
    counts = ", ".join(f"count(kind) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE_KINDS)
    text = "kind || ':' || s || ':' || e"
    base = f"coalesce(string_agg({text}, ',' ORDER BY s, ord) FILTER (ord < {len(pii.BASE_KINDS)}), '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS ({' UNION ALL '.join(_kind_sql(k) for k in pii.KINDS)})
SELECT doc_id, {counts}, sha256({base}) AS base_sha256, coalesce(string_agg({text}, ',' ORDER BY s, ord), '') AS spans
FROM d LEFT JOIN p USING (doc_id) GROUP BY doc_id
"""


def _crc_is_even(value: str) -> str:
    """Whether 2 divides the CRC-32 of an ASCII text: bytes and shifts as one list of steps, folded."""
    steps = (f"flatten(list_transform(string_split({value}, ''), "
             "lambda c: list_prepend(ascii(c)::BIGINT, list_transform(range(8), lambda i: -1::BIGINT))))")
    fold = ("lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END")
    return f"list_reduce(list_prepend(4294967295::BIGINT, {steps}), {fold}) % 2 = 1"  # the checksum is the complement


def _leaf(text: str) -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP11_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, {_leaf('text')} AS h,
    CASE WHEN {_crc_is_even('doc_id::VARCHAR')} THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS tampered
  FROM documents),
named AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaf GROUP BY source),
placed AS (
  SELECT doc_id, h, tampered, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx
  FROM leaf JOIN named ON leaf.source IS NOT DISTINCT FROM named.source),
lower AS (
  SELECT 0 AS lvl, tree, idx, n, h FROM placed
  UNION ALL
  SELECT lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM lower
  WHERE n > 1 GROUP BY lvl, tree, idx // 3, n),
sub AS (SELECT tree, h AS subroot, lvl AS height FROM lower WHERE n = 1),
upper AS (
  SELECT 0 AS lvl, tree AS idx, count(*) OVER () AS n, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM upper
  WHERE n > 1 GROUP BY lvl, idx // 3, n),
steps AS (
  SELECT p.doc_id, p.h AS leaf, p.tree, p.idx, l.lvl, l.idx AS sib, p.idx // (3 ** l.lvl)::BIGINT AS me, l.h
  FROM placed p JOIN lower l ON l.tree = p.tree AND l.n > 1 AND l.idx // 3 = p.idx // (3 ** (l.lvl + 1))::BIGINT
  UNION ALL
  SELECT p.doc_id, p.h, p.tree, p.idx, 1000 + u.lvl, u.idx, p.tree // (3 ** u.lvl)::BIGINT, u.h
  FROM placed p JOIN upper u ON u.n > 1 AND u.idx // 3 = p.tree // (3 ** (u.lvl + 1))::BIGINT),
step AS (
  SELECT tree, idx, lvl, coalesce(string_agg(h, '' ORDER BY sib) FILTER (sib < me), '') AS l,
    coalesce(string_agg(h, '' ORDER BY sib) FILTER (sib > me), '') AS r
  FROM steps GROUP BY tree, idx, lvl),
proof AS (SELECT tree, idx, string_agg(l || r, '' ORDER BY lvl) AS siblings, list(l || '|' || r ORDER BY lvl) AS way
  FROM step GROUP BY tree, idx),
done AS (
  SELECT doc_id, placed.h AS leaf, subroot, (SELECT h FROM upper WHERE n = 1) AS root, coalesce(siblings, '') AS siblings,
    list_reduce(list_prepend(tampered, coalesce(way, [])),
      lambda node, s: sha256(split_part(s, '|', 1) || node || split_part(s, '|', 2))) AS folded_root
  FROM placed JOIN sub USING (tree) LEFT JOIN proof USING (tree, idx))
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified FROM done
"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_DRAWS = ", ".join(f"('0x' || substr(h, {8 * k - 7}, 8))::BIGINT AS h{k}" for k in (1, 2, 3, 4))

OP12_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '{_UNIT}') AS units, {_DRAWS} FROM d),
c AS (
  SELECT *, length(units) AS n, least(h1 % (length(units) + 1), h2 % (length(units) + 1)) AS a,
    greatest(h1 % (length(units) + 1), h2 % (length(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
    array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
