"""DuckDB SQL that says what the queries say; common table expressions, built up."""

from __future__ import annotations

from ..constants import ABBREVIATIONS, KEY_CAPS, LEGAL_WORDS, SCREEN_CUTOFFS, THRESHOLDS, WEB_ADDRESS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def clean(x: str) -> str:
    """A list of normalized words."""
    stem = rf"regexp_replace(lower(coalesce({x}, '')), '{WEB_ADDRESS}', ' \1 ', 'g')"
    plain = f"regexp_replace(strip_accents(replace(replace({stem}, '&', ' and '), 'ß', 'ss')), '[^\\w]+', ' ', 'g')"
    spelled = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ABBREVIATIONS.items())
    one = f"CASE w {spelled} ELSE CASE WHEN regexp_full_match(w, '[0-9]+') AND length(w) < 12 THEN CAST(CAST(w AS BIGINT) AS VARCHAR) ELSE w END END"
    return f"list_transform(list_filter(string_split({plain}, ' '), lambda w: w <> ''), lambda w: {one})"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def text(x: str) -> str:
    return f"array_to_string({clean(x)}, ' ')"


def core(name: str) -> str:
    left = f"array_to_string(list_filter({words(name)}, lambda w: NOT list_contains({_list(LEGAL_WORDS)}, w)), ' ')"
    return f"CASE WHEN {left} = '' THEN {name} ELSE {left} END"


def numbers(x: str) -> str:
    return f"regexp_extract_all({x}, '[0-9]+')"


#: Bytes of an ASCII text, then eight steps a byte.
CRC32 = (
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda ch: CAST(ord(ch) AS BIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), "
    "lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))"
)


def crc32(x: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"xor({CRC32.format(x=x)}, 4294967295::BIGINT)"


PARTY = """
nations AS (SELECT n_nationkey, n_name, lower(r_name) AS country FROM nation JOIN region ON n_regionkey = r_regionkey),
party AS (
  SELECT 'S1-' || c_custkey AS entity_id, c_name AS business_name, c_mktsegment || ' ' || n_name || ' ' || (c_custkey * 7 % 1000) AS business_address, country, 1 AS source
  FROM customer JOIN nations ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'S2-' || c_custkey,
         CASE c_custkey % 5 WHEN 1 THEN upper(c_name) || ' Inc' WHEN 2 THEN substr(c_name, 1, length(c_name) - 1) WHEN 3 THEN 'Trading ' || c_custkey ELSE c_name END,
         CASE WHEN c_custkey % 5 = 4 THEN (c_custkey * 7 % 1000) || ' ' || n_name || ' ' || c_mktsegment ELSE c_mktsegment || ' ' || n_name || ' ' || (c_custkey * 7 % 1000) END, country, 2
  FROM customer JOIN nations ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'S3-' || s_suppkey, s_name, 'HOUSEHOLD ' || n_name || ' ' || (s_suppkey * 7 % 1000), country, 3
  FROM supplier JOIN nations ON s_nationkey = n_nationkey)"""

RECORDS = f"""{PARTY},
named AS (SELECT entity_id, {text('business_name')} AS name, {text('business_address')} AS address, lower(trim(country)) AS country, source FROM party),
rec AS (SELECT *, {core('name')} AS core FROM named)"""


def _key_lists() -> dict[str, str]:
    """tag: a list of keys, over core, name, address and t (distinct core words, sorted), aw (address words), ns."""
    one = lambda ok, x: f"CASE WHEN {ok} THEN [{x}] ELSE []::VARCHAR[] END"
    word = "NOT regexp_full_match(w, '[0-9]+')"
    pairs = lambda lst, key: f"flatten(list_transform(range(1, len({lst}) + 1), lambda i: list_transform(range(i + 1, len({lst}) + 1), lambda j: {key(f'{lst}[i]', f'{lst}[j]')})))"
    colon = lambda u, v: f"{u} || ':' || {v}"
    return {
        "n": one("name <> ''", "name"),
        "c": one("core <> ''", "core"),
        "s": one("len(t) > 0", "array_to_string(t, ' ')"),
        "a": one("address <> ''", "address"),
        "p": one("length(core) >= 5", "substr(core, 1, 6)"),
        "q": one("length(core) >= 5", "right(core, 6)"),
        "t": "list_filter(t, lambda w: length(w) >= 3)",
        "w": "list_transform(list_filter(t, lambda w: length(w) >= 6), lambda w: substr(w, 1, 4) || right(w, 2))",
        "j": pairs("t8", colon),
        "k": pairs("t8long", lambda u, v: f"substr({u}, 1, 4) || ':' || substr({v}, 1, 4)"),
        "m": one("replace(core, ' ', '') <> ''", "replace(core, ' ', '')"),
        "f": one("length(replace(core, ' ', '')) >= 7", "substr(replace(core, ' ', ''), 1, 8)"),
        "h": one("len(aw) >= 2", "array_to_string(aw[1:3], ' ')"),
        "b": f"list_filter(aw, lambda w: length(w) >= 5 AND {word})",
        "e": f"list_transform(list_filter(range(1, len(aw)), lambda i: length(aw[i]) >= 3 AND length(aw[i + 1]) >= 3 AND NOT regexp_full_match(aw[i], '[0-9]+') AND NOT regexp_full_match(aw[i + 1], '[0-9]+')), lambda i: aw[i] || ':' || aw[i + 1])",
        "d": f"flatten(list_transform(list_distinct(ns[1:3]), lambda n: list_transform(list_filter(aw, lambda w: length(w) >= 4 AND {word}), lambda w: n || ':' || w)))",
        "v": pairs("n6", colon),
        "x": "flatten(list_transform(list_filter(t[1:4], lambda w: length(w) >= 3), lambda w: list_transform(n6, lambda n: substr(w, 1, 4) || ':' || n)))",
    }


def _keys() -> str:
    lists = _key_lists()
    each = " UNION ALL ".join(f"SELECT entity_id, country, source, '{tag}' AS tag, unnest({lst}) AS key FROM parts" for tag, lst in lists.items())
    caps = ", ".join(f"('{k}', {v})" for k, v in KEY_CAPS.items())
    return f"""{RECORDS},
parts0 AS (SELECT *, list_sort(list_distinct({words('core')})) AS t, {words('address')} AS aw, {numbers('address')} AS ns FROM rec),
parts AS (SELECT *, t[1:8] AS t8, list_filter(t[1:8], lambda w: length(w) >= 4) AS t8long, list_sort(list_distinct(ns))[1:6] AS n6 FROM parts0),
keys AS (SELECT DISTINCT entity_id, country, source, tag, key FROM ({each})),
caps(tag, cap) AS (VALUES {caps}),
df AS (SELECT country, tag, key, count(*) AS df FROM keys WHERE source = 1 GROUP BY ALL),
usable AS (SELECT df.* FROM df JOIN caps USING (tag) WHERE df <= cap),
routes AS (SELECT a.entity_id AS anchor, b.entity_id AS candidate, tag, key FROM keys a JOIN usable USING (country, tag, key) JOIN keys b USING (country, tag, key) WHERE a.source = 1 AND b.source <> 1),
cand AS (SELECT DISTINCT anchor, candidate FROM routes)"""


KEYS = _keys()
PAIRS = f"""{KEYS},
pairs AS (SELECT anchor, candidate, x.name AS xn, x.address AS xa, x.core AS xc, x.country AS country, y.name AS yn, y.address AS ya, y.core AS yc, y.source AS ysource
          FROM cand JOIN rec x ON x.entity_id = anchor JOIN rec y ON y.entity_id = candidate)"""


def jaccard(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} > 0 THEN len(list_intersect(list_distinct({a}), list_distinct({b}))) / {union} ELSE 0.0 END"


def contained(a: str, b: str) -> str:
    return f"len(list_intersect(list_distinct({a}), list_distinct({b}))) / greatest(1, least(len(list_distinct({a})), len(list_distinct({b}))))"


#: A score without a model: the Jaccard similarity of the core words; a screening score: that of the address words.
SCORED = f"""{PAIRS},
truth AS (SELECT 'S1-' || c_custkey AS anchor, 'S2-' || c_custkey AS candidate FROM customer),
anchors AS (SELECT entity_id AS anchor, country, 1 AS "true" FROM rec WHERE source = 1),
scored AS (SELECT anchor, candidate, country, CASE WHEN substr(anchor, 4) = substr(candidate, 4) AND ysource = 2 THEN 1 ELSE 0 END AS label, 1 AS retrieved,
                  round({jaccard(words('xc'), words('yc'))}, 6) AS score, round({jaccard(words('xa'), words('ya'))}, 6) AS screen FROM pairs)"""


def f05(p: str, h: str, t: str) -> str:
    return f"CASE WHEN {p} + 0.25 * {t} = 0 THEN 1.0 ELSE 1.25 * {h} / ({p} + 0.25 * {t}) END"


def scores(threshold: float | str, extra: str = "true") -> str:
    """A table of per-entity scores at a threshold."""
    return f"""SELECT a.*, coalesce(p, 0) AS predicted, coalesce(h, 0) AS hits, {f05('coalesce(p, 0)', 'coalesce(h, 0)', '"true"')} AS f
FROM anchors a LEFT JOIN (SELECT anchor, count(*) AS p, sum(label) AS h FROM scored WHERE retrieved = 1 AND score >= {threshold} AND {extra} GROUP BY 1) USING (anchor)"""


GRID = ", ".join(f"({t})" for t in THRESHOLDS)
SWEEP = f"""{SCORED}, grid(threshold) AS (VALUES {GRID}),
counts AS (SELECT anchor, threshold, count(*) AS p, sum(label) AS h FROM scored JOIN grid ON score >= threshold GROUP BY ALL),
swept AS (SELECT country, threshold, {f05('coalesce(p, 0)', 'coalesce(h, 0)', '"true"')} AS f FROM anchors CROSS JOIN grid LEFT JOIN counts USING (anchor, threshold))"""
CUTOFFS = ", ".join(f"({c})" for c in SCREEN_CUTOFFS)


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two columns, up to 120 characters: bit-parallel, a bit a character of ``a``."""
    mask = f"list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, CAST(i + 1 AS BIGINT), 1) = ch THEN (1::HUGEINT << CAST(i AS INTEGER)) ELSE 0::HUGEINT END))"
    masks = f"list_transform(string_split({b}, ''), lambda ch: CAST(coalesce({mask}, 0) AS HUGEINT))"
    full = f"((1::HUGEINT << CAST(length({a}) AS INTEGER)) - 1)"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - bit_count(list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})) END"


def ratio(a: str, b: str) -> str:
    """``similarity.ratio`` of two columns; equal texts need no counting."""
    return f"CASE WHEN {a} = {b} THEN 100.0::DOUBLE ELSE 200.0 * ({common(a, b)}) / (length({a}) + length({b})) END"


#: Scores of different pairs of texts of the columns a and b of a table ``texts``: sorted words, and the three sides of the word sets.
KERNELS = f"""
sides AS (SELECT *, list_sort(list_intersect(list_distinct(wa), list_distinct(wb))) AS meet, list_sort(list_distinct(list_filter(wa, lambda w: NOT list_contains(wb, w)))) AS left_, list_sort(list_distinct(list_filter(wb, lambda w: NOT list_contains(wa, w)))) AS right_
  FROM (SELECT DISTINCT a, b, {words('a')} AS wa, {words('b')} AS wb FROM texts)),
strings AS (SELECT *, array_to_string(list_sort(wa), ' ') AS sa, array_to_string(list_sort(wb), ' ') AS sb, array_to_string(meet, ' ') AS shared,
  array_to_string(list_concat(meet, left_), ' ') AS one, array_to_string(list_concat(meet, right_), ' ') AS two FROM sides),
kernels AS (SELECT a, b, {ratio('a', 'b')} AS ratio, {ratio('sa', 'sb')} AS token_sort,
  CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0 WHEN len(meet) > 0 AND (len(left_) = 0 OR len(right_) = 0) THEN 100.0
       ELSE greatest({ratio('one', 'two')}, CASE WHEN len(meet) > 0 THEN greatest({ratio('shared', 'one')}, {ratio('shared', 'two')}) ELSE 0.0 END) END AS token_set FROM strings)"""


def kernels(a: str, b: str, table: str = "pairs") -> str:
    """Common table expressions up to ``kernels`` (a, b, ratio, token_sort, token_set) of the columns ``a`` and ``b`` of ``table``."""
    return f"texts AS (SELECT {a} AS a, {b} AS b FROM {table}),{KERNELS}"


#: The gate's verdict, and the screening scores, of ``pairs``.
GATED = f"""{PAIRS},
texts AS (SELECT xn AS a, yn AS b FROM pairs UNION SELECT xc, yc FROM pairs UNION SELECT xa, ya FROM pairs),{KERNELS},
screened AS (SELECT p.*, n.ratio AS name_ratio, c.ratio AS core_ratio, c.token_sort AS core_sort, c.token_set AS core_set, d.ratio AS address_ratio, d.token_sort AS address_sort, d.token_set AS address_set
  FROM pairs p JOIN kernels n ON n.a = xn AND n.b = yn JOIN kernels c ON c.a = xc AND c.b = yc JOIN kernels d ON d.a = xa AND d.b = ya),
gated AS (SELECT * FROM screened WHERE greatest(core_ratio, core_sort) >= 45 OR (xc <> '' AND yc <> '' AND core_set >= 85) OR (xa <> '' AND ya <> '' AND (address_sort >= 55 OR address_set >= 85)))"""


def for_documents(text: str) -> str:
    """``text`` (common table expressions over the party tables) with records of documents in place of parties."""
    return text.replace(PARTY, DOCUMENT_PARTY)


#: Records made of documents: their words are names and addresses; the language is the country.
DOCUMENT_PARTY = """
party AS (
  SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, array_to_string(w[1:5], ' ') AS business_name, array_to_string(w[6:13], ' ') AS business_address, lang AS country, CAST(doc_id % 3 + 1 AS INTEGER) AS source
  FROM (SELECT doc_id, lang, list_filter(string_split(regexp_replace(strip_accents(replace(lower(text), 'ß', 'ss')), '[^a-z0-9_]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents))"""
