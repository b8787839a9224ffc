"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

import math

from .quality_rules import (
    BINS_PER_OCTAVE, CELLS, CUTOFF, FARTHEST, FIRST_STEPS, FLOORS, INNER, INSIDE, LEAST_GAIN, NEAREST, PRIOR, SHRINK, WIDTHS,
    consistency,
)
from .secret_ledger import BASE_RULES, RULES

#: Words of ``TEXT``: A-Z folded, then runs of digits, letters and non-ASCII characters.
_WORDS = (
    "regexp_extract_all(translate(coalesce(TEXT, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[0-9a-z\x{80}-\x{10FFFF}]+')"
)

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.replace('TEXT', 'text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.replace('TEXT', 'text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, list_slice(w, i, i + 12) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM win),
spots AS (
  SELECT r, i, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)
),
found AS (SELECT r, i, spots.k, item_id FROM spots JOIN win ON spots.g = win.g AND spots.k = win.k),
hit AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM found))
  GROUP BY r
),
item AS (
  SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(item.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)
"""

_MARKS = r"regexp_replace(TEXT, '<(\\*)\|', '<\\\1|', 'g')"
_LINE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"

OP1 = f"""
WITH c AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
  )
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || {_MARKS.replace('TEXT', _LINE)} || chr(10) || {_MARKS.replace('TEXT', 'text')}
    || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP5 = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.replace('TEXT', 'text')} AS w FROM documents),
s AS (
  SELECT DISTINCT r, list_slice(w, i, i + 4) AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
sig AS (SELECT r, string_agg(md5(g::VARCHAR), '' ORDER BY md5(g::VARCHAR)) AS sig FROM s GROUP BY r),
cls AS (SELECT sig, min(r) AS c, count(*) AS copies FROM sig GROUP BY sig),
rows AS (SELECT r, doc_id, c, copies FROM w LEFT JOIN sig USING (r) LEFT JOIN cls USING (sig)),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS k FROM (SELECT * FROM s WHERE r IN (SELECT c FROM cls)) a
  JOIN (SELECT * FROM s WHERE r IN (SELECT c FROM cls)) b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2
),
pair AS (
  SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 5 * k >= 4 * (x.n + y.n - k)
),
mutual AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
links AS (SELECT a AS c, sum(copies) AS links FROM mutual JOIN cls ON cls.c = b GROUP BY 1),
reach AS (SELECT c AS a, c AS b FROM cls UNION SELECT reach.a, mutual.b FROM reach JOIN mutual ON mutual.a = reach.b),
least AS (SELECT c, min(doc_id) AS low FROM rows WHERE c IS NOT NULL GROUP BY c),
comp AS (SELECT reach.a AS c, min(low) AS class_id FROM reach JOIN least ON least.c = reach.b GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id,
  CAST(coalesce(copies - 1, 0) + coalesce(links, 0) AS BIGINT) AS n_links,
  CAST(coalesce(copies, 1) AS BIGINT) AS n_copies
FROM rows LEFT JOIN links USING (c) LEFT JOIN comp USING (c)
"""

OP6 = f"""
WITH w AS (SELECT doc_id, {_WORDS.replace('TEXT', 'text')} AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i + 1, i + 50), ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)
),
twice AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT doc_id, i, low FROM g JOIN twice USING (g)),
step AS (
  SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new FROM hit
),
run AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM step)
SELECT doc_id, CAST(min(i) AS INTEGER) AS first_word, CAST(max(i) + 50 AS INTEGER) AS end_word, min(low) AS first_doc_id
FROM run GROUP BY doc_id, k
"""

def _op10() -> str:
    """Rule counts, then the search for the least determinant: two steps from three starts, and a walk from the best."""
    floors, p, cells = FLOORS, len(FLOORS), CELLS
    stats = ", ".join(f"f{k}" for k in range(p))
    numbers = ", ".join([*(f"m{k}" for k in range(p)), *(f"c{i}{j}" for i, j in cells)])
    level = " + ".join(f"ln(l{i}{i})" for i in range(p))

    def triangle(source: str) -> str:
        """Cholesky factor of the covariance (c..) of ``source``, one entry after the other, and its level."""
        inner = f"SELECT * FROM {source}"
        for i, j in cells:
            taken = " ".join(f"- l{i}{k} * l{j}{k}" for k in range(j))
            if i == j:
                value = f"sqrt(greatest(c{i}{j} + {floors[i] ** 2!r} {taken}, {floors[i] ** 2 / 4!r}))"
            else:
                value = f"(c{i}{j} {taken}) / l{j}{j}"
            inner = f"SELECT *, {value} AS l{i}{j} FROM ({inner})"
        return f"SELECT *, {level} AS level FROM ({inner})"

    def distance(source: str) -> str:
        inner = source
        for i in range(p):
            taken = " ".join(f"- l{i}{k} * z{k}" for k in range(i))
            inner = f"SELECT *, (f{i} - m{i} {taken}) / l{i}{i} AS z{i} FROM ({inner})"
        return f"SELECT *, {' + '.join(f'z{i} * z{i}' for i in range(p))} AS distance FROM ({inner})"

    def moments(share: float) -> str:
        spread = (f"{consistency(share)!r} * covar_pop(f{i}, f{j}) AS c{i}{j}" for i, j in cells)
        return ", ".join([*(f"avg(f{k}) AS m{k}" for k in range(p)), *spread])

    def middle(values: list[str], name: str) -> str:
        bins = (f"floor({v} / {w!r} + 0.5)" for v, w in zip(values, WIDTHS, strict=True))
        return ", ".join(f"list({x} ORDER BY {x})[(count(*) + 1) // 2] * {w!r} AS {name}{k}" for k, (x, w) in enumerate(zip(bins, WIDTHS, strict=True)))

    def concentrate(source: str, keep: str) -> str:
        """Mean and covariance of the nearest half of each group, by bins of distance; one use of ``source``."""
        far = distance(f"SELECT {stats}, e.* FROM g JOIN {source} e USING (grp)")
        bins = f"floor(ln(least(greatest(distance, {NEAREST!r}), {FARTHEST!r})) * {BINS_PER_OCTAVE / math.log(2)!r})"
        near = f"SELECT *, {bins} AS bin FROM ({far})"
        placed = f"SELECT *, row_number() OVER (PARTITION BY grp, start ORDER BY bin) AS place FROM ({near})"
        half = f"CASE WHEN place = least(n, (n + {p + 1}) // 2) THEN bin END"
        bound = f"SELECT *, max({half}) OVER (PARTITION BY grp, start) AS bound FROM ({placed})"
        return triangle(f"(SELECT grp, start, any_value(n) AS n{keep}, {moments(0.5)} FROM ({bound}) WHERE bin <= bound GROUP BY grp, start)")

    def towards(own: str, wide: str, on: str, apart: bool) -> str:
        weight = f"(o.n / (o.n + {SHRINK}.0))"
        blend = lambda c: f"{weight} * o.{c} + (1 - {weight}) * w.{c}"
        gap = lambda i, j: f" + {weight} * (1 - {weight}) * (o.m{i} - w.m{i}) * (o.m{j} - w.m{j})" if apart else ""
        drawn = [*(f"{blend(f'm{k}')} AS m{k}" for k in range(p)), *(f"{blend(f'c{i}{j}')}{gap(i, j)} AS c{i}{j}" for i, j in cells)]
        return f"SELECT o.grp, o.n, {', '.join(drawn)} FROM {own} o JOIN {wide} w ON {on}"

    scores = ", ".join(f"(f{k} - m{k}) / s{k} AS z{k}" for k in range(p))
    length = f"greatest({' + '.join(f'z{k} * z{k}' for k in range(p))}, 1e-12)"
    signs = ", ".join(f"avg(z{i} * z{j} / {length}) AS a{i}{j}" for i, j in cells)
    bounded = ", ".join(f"avg(tanh(z{i}) * tanh(z{j})) AS b{i}{j}" for i, j in cells)
    centres = ", ".join(f"m{k}" for k in range(p))
    starts = (
        ", ".join(f"s{i} * s{j} AS c{i}{j}" if i == j else f"0.0 AS c{i}{j}" for i, j in cells),
        ", ".join(f"{p} * a{i}{j} * (s{i} * s{j}) AS c{i}{j}" for i, j in cells),
        ", ".join(f"b{i}{j} * (s{i} * s{j}) AS c{i}{j}" for i, j in cells),
    )
    three = " UNION ALL ".join(f"SELECT grp, {k} AS start, n, {centres}, {c} FROM shapes" for k, c in enumerate(starts))
    deviations = ", ".join(f"sqrt(pow(1.4826 * d{k}, 2) + {f ** 2!r}) AS s{k}" for k, f in enumerate(floors))
    spread = middle([f"abs(f{k} - m{k})" for k in range(p)], "d")
    tables = [
        f"centre AS MATERIALIZED (SELECT grp, count(*) AS n, {middle([f'f{k}' for k in range(p)], 'm')} FROM g GROUP BY grp)",
        f"spread AS (SELECT grp, {spread} FROM g JOIN centre USING (grp) GROUP BY grp)",
        f"scale AS MATERIALIZED (SELECT centre.*, {deviations} FROM centre JOIN spread USING (grp))",
        f"scored AS (SELECT grp, {scores} FROM g JOIN scale USING (grp))",
        f"shapes AS MATERIALIZED (SELECT * FROM scale JOIN (SELECT grp, {signs}, {bounded} FROM scored GROUP BY grp) USING (grp))",
        f"e0 AS MATERIALIZED ({triangle(f'({three})')})",
        *(f"e{k + 1} AS MATERIALIZED ({concentrate(f'e{k}', '')})" for k in range(FIRST_STEPS)),
        f"best AS MATERIALIZED (SELECT * FROM e{FIRST_STEPS} QUALIFY row_number() OVER (PARTITION BY grp ORDER BY level, start) = 1)",
        f"walk AS (SELECT *, 0 AS turn, CAST(NULL AS DOUBLE) AS before FROM best UNION ALL SELECT grp, start, n, {numbers}, "
        + ", ".join(f"l{i}{j}" for i, j in cells)
        + f", level, turn, before FROM ({concentrate('walk', ', any_value(turn) + 1 AS turn, any_value(level) AS before')}) "
        f"WHERE level < before - {LEAST_GAIN!r})",
        "found AS MATERIALIZED (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY grp ORDER BY turn DESC) = 1)",
        f"inside AS ({distance(f'SELECT {stats}, e.* FROM g JOIN found e USING (grp)')})",
        f"raw AS MATERIALIZED (SELECT grp, any_value(n) AS n, {moments(INNER)} FROM inside WHERE distance <= {INSIDE!r} GROUP BY grp)",
        "top AS (SELECT grp, n, " + centres + ", "
        + ", ".join(f"n / (n + {SHRINK}.0) * c{i}{j}" + (f" + (1 - n / (n + {SHRINK}.0)) * {(PRIOR * floors[i]) ** 2!r}" if i == j else "") + f" AS c{i}{j}" for i, j in cells)
        + " FROM raw WHERE grp = '')",
        f"langs AS MATERIALIZED ({towards('(SELECT * FROM raw WHERE grp IN (SELECT wide FROM s))', 'top', 'true', True)})",
        f"owns AS ({towards('(SELECT * FROM raw JOIN (SELECT DISTINCT own AS grp, wide FROM s) USING (grp))', 'langs', 'o.wide = w.grp', False)})",
    ]
    judged = distance(f"SELECT s.r, {stats}, e.* FROM s LEFT JOIN ({triangle('owns')}) e ON e.grp = own")
    return (
        r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
),
grams AS (SELECT r, i, list_slice(w, i, i + 4) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) > 5)),
again AS (SELECT r, i FROM grams JOIN (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM again) GROUP BY r),
counts AS (
  SELECT r, doc_id, lang, source, text, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN hit USING (r)
),
s AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    ln((word_chars + 150.0) / (n_words + 30.0)) AS f0, ln(1 + 100.0 * n_symbols / greatest(word_chars, 1)) AS f1,
    n_dup_lines / (n_dup_lines + 10.0) AS f2, n_repeat_words / greatest(n_words, 1) AS f3,
    coalesce('l' || lang, 'n') || chr(0) || coalesce('s' || source, 'n') AS own, coalesce('l' || lang, 'n') AS wide
  FROM counts
),
"""
        + f"g AS MATERIALIZED (SELECT grp, {stats} FROM (SELECT DISTINCT grp, text, {stats} FROM "
        + "(SELECT *, unnest([own, wide, '']) AS grp FROM s WHERE NOT base_failed))),\n"
        + ",\n".join(tables)
        + f",\nj AS ({judged})\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        + f"NOT base_failed AND NOT coalesce(distance > {CUTOFF!r}, false) AS kept FROM s JOIN j USING (r)"
    )


#: CRC-32 of a decimal number's text, bit by bit; 3988292384 is its reversed polynomial.
_CRC32 = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"
)

#: Of a run of period q, the 16 words at its start stand again q words later, and so do all after them up to its end.
OP11 = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, {_CRC32} AS h,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
loop AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
    CASE WHEN h % 10 = 0 AND len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) END AS p FROM w
),
d AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN p IS NULL THEN w
    ELSE list_transform(range(len(w)), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM loop
),
word AS (SELECT r, i, w[i + 1] AS x FROM (SELECT r, w, unnest(range(len(w))) AS i FROM d)),
gram AS (
  SELECT r, i, md5(array_to_string(list_slice(w, i + 1, i + 16), ' ')) AS g
  FROM (SELECT r, w, unnest(range(len(w) - 15)) AS i FROM d WHERE len(w) > 15)
),
same AS (SELECT r, a.i, b.i - a.i AS q FROM gram a JOIN gram b USING (r, g) WHERE a.i < b.i),
island AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same),
stretch AS (SELECT r, q, min(i) AS start, max(i) + 16 + q - min(i) AS length FROM island GROUP BY r, q, k),
run AS (
  SELECT r, start, length, min(q) AS period FROM stretch WHERE length >= greatest(24, 3 * q) GROUP BY r, start, length
),
top AS (
  SELECT DISTINCT ON (r) * FROM run ORDER BY r, CAST(length AS DOUBLE) / period DESC, start, period
),
lines AS (
  SELECT r, count(*) AS n, string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS t
  FROM run GROUP BY r
),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
rest AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(rest.t, '')) AS collapsed_sha256
FROM d LEFT JOIN top USING (r) LEFT JOIN lines USING (r) LEFT JOIN rest USING (r)
"""

OP12 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
k AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM v),
score AS MATERIALIZED (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS alike,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS s
  FROM (SELECT * FROM k WHERE vec_id % 100 = 0) a, k b WHERE a.r <> b.r
),
pos AS (
  SELECT r, anchor_id, other, vec_id AS positive_id, s AS positive_score FROM score WHERE alike
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id) <= 5
)
SELECT pos.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY pos.r, pos.other ORDER BY s DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, s AS negative_score
FROM pos JOIN score ON score.r = pos.r AND NOT alike AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
QUALIFY rank <= 5
"""



def _op13() -> str:
    """Matches of each rule, placed by the lengths of all pieces of the text before them."""

    def matches(k: int) -> str:
        rule, pattern = RULES[k], "'" + RULES[k].pattern.replace("'", "''") + "'"
        return (
            f"SELECT r, {k} AS k, '{rule.kind}' AS kind, {rule.least} AS least, regexp_extract_all(text, {pattern}) AS m, "
            f"regexp_extract_all(text, {pattern}, {rule.group}) AS part, string_split_regex(text, {pattern}) AS rest "
            f"FROM t WHERE regexp_matches(text, {pattern})"
        )

    count = lambda kind: f"count(*) FILTER (kind = '{kind}') AS n_{kind}"
    line = "kind || ':' || start || ':' || (start + size)"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(matches(k) for k in range(len(RULES)))}),
x AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m),
span AS (
  SELECT r, k, kind, length(m[i]) AS size,
    CAST(list_sum(list_transform(rest[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS BIGINT) AS start
  FROM x WHERE length(part[i]) >= least
),
per AS (
  SELECT r, {", ".join(count(rule.kind) for rule in BASE_RULES)},
    string_agg({line}, ',' ORDER BY start, k) FILTER (k < {len(BASE_RULES)}) AS base, string_agg({line}, ',' ORDER BY start, k) AS spans
  FROM span GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM t LEFT JOIN per USING (r)
"""


ORACLE_SQL: dict[str, str] = {"op1_chat_format": OP1, "op2_decontamination": OP2, "op5_jaccard_join": OP5, "op6_suffix_dedup": OP6, "op10_quality_rules": _op10(), "op11_periodic_runs": OP11, "op12_hard_negatives": OP12, "op13_secrets": _op13()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
