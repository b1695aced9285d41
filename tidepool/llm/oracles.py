"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

HASH60 = "('0x' || substr(md5({}), 1, 15))::BIGINT"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
W = r"[^\x20\x09-\x0D]+"


# The reflected polynomial's table of 256 remainders, from its rule, and the crc32 of a text over it.
CRC_TABLE = """SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(encode({})), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""


def _shard(n: int) -> str:
    draw = HASH60.format("coalesce(doc_id::VARCHAR, '\\N') || '|' || s")
    return f"(SELECT arg_max(s, ({draw}, s)) FROM range({n}) r(s))"


def _lloyd(rounds: int) -> str:
    """Rounds of nearest entry and mean, rounded down, from the codebooks ``c0``, and the last assignment ``a``; numbers are exact in doubles."""
    def nearest(book: int) -> str:
        far = "list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, c.x) + list_dot_product(c.x, c.x)"
        return f"""SELECT p.rid, p.part, min({{'far': {far}, 'entry': c.entry}}) AS m
  FROM p JOIN c{book} c USING (part) GROUP BY p.rid, p.part"""

    steps = [f"""a{k} AS MATERIALIZED (
  {nearest(k - 1)}
), m{k} AS (
  SELECT part, m.entry AS entry, i, floor(sum(x[i]) / count(*)) AS v
  FROM a{k} JOIN p USING (rid, part), unnest(range(1, len(x) + 1)) u(i) GROUP BY ALL
), c{k} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.x, c.x) AS x
  FROM c{k - 1} c LEFT JOIN (SELECT part, entry, list(v ORDER BY i) AS x FROM m{k} GROUP BY ALL) n USING (part, entry)
)""" for k in range(1, rounds + 1)]
    return ",\n".join(steps) + f",\na AS (\n  {nearest(rounds)}\n)"


ORACLES: dict[str, str] = {
    "op3_curriculum_mix": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), q AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '{W}')) AS size,
         {HASH60.format("coalesce(doc_id::VARCHAR, '\\N') || '|0'")} AS draw
  FROM d
), a AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS ahead
  FROM q
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
  FROM q GROUP BY source
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][place + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), p AS (
  SELECT source, source_size, place,
         least(cap, (SELECT arg_min(level, cap / w) FROM l WHERE cap >= level * w) * w) AS target
  FROM l
), m AS (
  SELECT a.doc_id, a.size, p.source_size, p.target, a.ahead + a.size / 2.0::DOUBLE AS middle,
         [1.5::DOUBLE, 1.0, 0.5][place + 1]::DOUBLE AS w0, [0.5::DOUBLE, 1.0, 1.5][place + 1]::DOUBLE AS w2
  FROM a JOIN p ON a.source IS NOT DISTINCT FROM p.source
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN greatest(0, ceil((target - middle) / source_size)) ELSE 0 END::INT AS copies,
         middle / target AS want, (w0 + 1.0::DOUBLE) / 2.0::DOUBLE * 0.5::DOUBLE AS g1
  FROM m
), r AS (
  SELECT *, sqrt(greatest(w0 * w0 + 2.0::DOUBLE * ((1.0::DOUBLE - w0) / 0.5::DOUBLE) * greatest(want, 0.0::DOUBLE), 0.0::DOUBLE)) AS r1,
         sqrt(greatest(1.0::DOUBLE + 2.0::DOUBLE * ((w2 - 1.0::DOUBLE) / 0.5::DOUBLE) * greatest(want - g1, 0.0::DOUBLE), 0.0::DOUBLE)) AS r2
  FROM c
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
       CASE WHEN copies > 0 THEN
            CASE WHEN want < g1 THEN least(0.5::DOUBLE, 2.0::DOUBLE * want / (w0 + r1))
                 ELSE 0.5::DOUBLE + least(0.5::DOUBLE, 2.0::DOUBLE * (want - g1) / (1.0::DOUBLE + r2)) END END AS first_position
FROM r
""",
    "op5_rendezvous": f"""
WITH tab AS (  -- the reflected polynomial's table of 256 remainders, from its rule
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_shard(24)} AS shard, {_shard(25)} AS grown_shard,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, tab
)
SELECT doc_id, (strlen(t) + 8)::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, crc) - 1 AS slot, grown_shard::INT AS grown_shard
FROM d
""",
    "op7_host_rules": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{W}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{W}')) AS ls
  FROM documents
), g AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM d, unnest(range(1, len(ws) - 1)) u(i)
), h AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), v AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM h, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
), r AS (
  SELECT d.doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN v USING (doc_id)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 20 * n_words AS soft_failed
  FROM r
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum((base_failed OR soft_failed)::INT)::DOUBLE AS k FROM f GROUP BY source
), p AS (
  SELECT sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS v FROM hosts
), z AS (
  SELECT m, CASE WHEN v > 1e-12 THEN greatest(1.0, least(10000.0, m * (1 - m) / v - 1)) ELSE 10000.0 END AS s FROM p
), b AS (
  SELECT source, (k + s * m) / (n + s) > 0.5 AS host_failed FROM hosts, z
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
       NOT base_failed AND NOT soft_failed AND NOT host_failed AS kept
FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source
""",
    "op8_doubling": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS w FROM documents
), g AS (
  SELECT doc_id, k, sha256(array_to_string(w[k:k + 34], ' ')) AS g FROM d, unnest(range(1, len(w) - 33)) u(k)
), r AS (
  SELECT doc_id, k FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1
), x AS (
  SELECT DISTINCT doc_id, x FROM r, unnest(range(k, k + 35)) u(x)
), c AS (
  SELECT doc_id, count(*) AS n, list(x) AS xs FROM x GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
                   ELSE coalesce((SELECT string_agg(w[i], ' ' ORDER BY i) FROM unnest(range(1, len(w) + 1)) u(i)
                                  WHERE NOT list_contains(xs, i)), '') END) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
""",
    "op10_fm_index": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{ALNUM}') AS w FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{ALNUM}') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS phrase
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(k) WHERE len(w) > 0
), o AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS phrase
  FROM d, (SELECT DISTINCT n FROM p), unnest(range(1, len(w) - n + 2)) u(k)
), h AS (
  SELECT o.doc_id, o.k, o.n, p.item FROM o JOIN p ON o.phrase = p.phrase AND o.n = p.n
), c AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT DISTINCT doc_id, k, n FROM h), unnest(range(k, k + n)) u(x) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""",
    "op12_gnat_codes": rf"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS q,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT rid, part, q[part * len(q) // 4 + 1:(part + 1) * len(q) // 4] AS x FROM v, range(4) r(part)
), c0 AS MATERIALIZED (
  SELECT part, rid - 1 AS entry, x FROM p WHERE rid <= 256
), {_lloyd(4)}, e AS (
  SELECT rid, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, sum(m.far)::BIGINT AS error FROM a GROUP BY rid
), s AS (
  SELECT sha256(string_agg(x[i]::BIGINT::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM c4, unnest(range(1, len(x) + 1)) u(i)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN e USING (rid), s
""",
    # Plainly: all pairs of equal words within a quarter of the text, stretches of them, the smallest period of each stretch.
    "op11_periodic_runs": rf"""
WITH tab AS (
  {CRC_TABLE}
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS w,
         {CRC.format("doc_id::VARCHAR")} AS h
  FROM documents, tab
), q AS (
  SELECT *, len(w)::BIGINT AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d
), t AS MATERIALIZED (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
  FROM q
), u AS MATERIALIZED (
  SELECT r, n, i, w[i + 1] AS x FROM t, unnest(range(n)) v(i)
), m AS (
  SELECT l.r, l.i - e.i AS q, l.i FROM u l JOIN u e ON l.r = e.r AND l.x = e.x AND e.i < l.i AND 4 * (l.i - e.i) <= l.n
), s AS (
  SELECT r, q, min(i) - q AS b, count(*) + q AS k
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m) GROUP BY r, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), o AS MATERIALIZED (
  SELECT * FROM s x WHERE NOT EXISTS (SELECT 1 FROM s y WHERE y.r = x.r AND y.b = x.b AND y.k = x.k AND y.q < x.q)
), z AS (
  SELECT r, count(*) AS n_runs, string_agg(b || ',' || k || ',' || q || chr(10), '' ORDER BY b, q) AS listed,
         arg_max({{'b': b, 'k': k, 'q': q}}, (k / q, -b, -q)) AS best
  FROM o GROUP BY r
), y AS (
  SELECT r, coalesce(string_agg(x, ' ' ORDER BY i), '') AS kept
  FROM u WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.r = u.r AND u.i >= o.b + o.q AND u.i < o.b + o.k) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.b::BIGINT AS start, best.k::BIGINT AS length, best.q::BIGINT AS period,
       (1000 * best.k // best.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN z USING (r) LEFT JOIN y USING (r)
""",
}
