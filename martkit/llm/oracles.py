"""DuckDB SQL of the operator queries that SQL can express."""

from __future__ import annotations

from . import licenses, urls

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(
         list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
raw AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x:
            (strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1) AS b FROM documents),
docs AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x:
            xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM raw, tab),
race AS (SELECT *, unnest(range(9)) AS s FROM docs),
point AS (SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '~') || ':' || s), 1, 13))::BIGINT + 0.5)
            / 4503599627370496.0) AS race FROM race),
won AS (SELECT doc_id, size, text_crc32, arg_min(s, race) FILTER (s < 8) AS shard, arg_min(s, race) AS grown_shard
        FROM point GROUP BY ALL)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), size,
           text_crc32)), 1, 3), doc_id, size, text_crc32) - 1 AS slot
FROM won
"""

_TOKENS = r"""list_sort(list_distinct(list_concat(
    list_transform(list_filter(string_split_regex(host, '[.-]'), lambda v: v != '' AND NOT regexp_matches(v, '^[0-9]+$')),
                   lambda v: 'host:' || v),
    list_transform(list_filter(string_split(regexp_replace(path, '\.([A-Za-z]+)$', ''), '/'),
                               lambda v: v != '' AND NOT regexp_matches(v, '^[0-9]+$')), lambda v: 'path:' || v),
    list_transform(list_filter([regexp_extract(path, '\.([A-Za-z]+)$', 1)], lambda v: v != ''), lambda v: 'end:' || v),
    list_transform(list_filter(list_transform(string_split(regexp_extract(more, '^\?([^#]*)', 1), '&'),
                                              lambda v: string_split(v, '=')[1]),
                               lambda v: v != '' AND NOT regexp_matches(v, '^[0-9]+$')), lambda v: 'name:' || v))))"""


def op3(rules: tuple[tuple[str, str], ...], mining: urls.Mining = urls.Mining()) -> str:
    """All sets of tokens of a labelled url are counted, each set by the bits of a number."""
    fits, says = [], []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        own, _, start = rule.partition("/")
        test = f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '/{start}')"
        fits.append(f"WHEN {test} THEN '{rule}'")
        says.append(f"WHEN {test} THEN '{verdict}'")
    return rf"""
WITH rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END
                  AS r FROM pages),
hosts AS (SELECT page_id, coalesce(regexp_extract(r, '^[^/?#]*'), '') AS h, coalesce(r, '') AS r FROM rest),
tails AS (SELECT page_id, translate(h, '{urls.UPPER}', '{urls.LOWER}') AS host, substr(r, length(h) + 1) AS tail FROM hosts),
split AS (SELECT page_id, host, regexp_extract(tail, '^[^?#]*') AS path,
                 substr(tail, length(regexp_extract(tail, '^[^?#]*')) + 1) AS more FROM tails),
base AS (SELECT page_id, host, path, {_TOKENS} AS tokens, CASE {' '.join(fits)} END AS rule,
                CASE {' '.join(says)} END AS says FROM split),
learn AS (SELECT row_number() OVER () AS n, tokens, (quality = 0 OR toxic = 1) AS blocked FROM base JOIN labels ON
          doc_id = TRY_CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:/|\.|$)', 1), '') AS BIGINT)
          WHERE (quality = 0 OR toxic = 1) IS NOT NULL),
part AS (SELECT blocked, unnest(list_transform(range(1, 1::BIGINT << len(tokens)), lambda m:
             list_filter(tokens, lambda t, i: (m >> (i - 1)) & 1 = 1))) AS s FROM learn),
sure AS (SELECT s, count(*) FILTER (blocked) / count(*) AS confidence FROM part GROUP BY s
          HAVING count(*) FILTER (blocked) >= {mining.least}
             AND count(*) FILTER (blocked) / count(*) >= {mining.confidence}),
rules AS (SELECT a.s, a.confidence FROM sure a WHERE NOT EXISTS (
          SELECT 1 FROM sure b WHERE len(b.s) < len(a.s) AND list_has_all(a.s, b.s))),
hit AS (SELECT tokens, max(confidence) AS confidence FROM (SELECT DISTINCT tokens FROM base WHERE rule IS NULL) p
        JOIN rules ON list_has_all(tokens, s) GROUP BY tokens)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN confidence END AS confidence,
       coalesce(says, CASE WHEN confidence IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM base LEFT JOIN hit USING (tokens)
"""


OP6 = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
dw AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
tri AS (SELECT r, i, a, lead(a, 1) OVER (PARTITION BY r ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY r ORDER BY i) AS c
        FROM dw),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri WHERE c IS NOT NULL),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1)
        GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
base AS (SELECT doc_id, text, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
                len(l) AS n_lines
         FROM w JOIN lines USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols * 10 <= n_words AND word_chars BETWEEN n_words * 2 AND n_words * 15
       AND n_dup_lines * 2 <= n_lines AND length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) * 10 <= word_chars * 6
       AND length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) * 2 >= word_chars AS kept
FROM judged
"""


def op7(templates: tuple[licenses.Template, ...] = licenses.TEMPLATES) -> str:
    rows = ", ".join(f"({i}, '{t.label}', '{t.text}', '{t.key}', {t.key_at})" for i, t in enumerate(templates))
    base = ", ".join(f"('{p}', '{label}')" for p, label in licenses.BASE)
    return rf"""
WITH tpl AS (SELECT * FROM (VALUES {rows}) v(t, label, body, key, key_at)),
tw AS (SELECT t, unnest(string_split(body, ' ')) AS w, generate_subscripts(string_split(body, ' '), 1) - 1 AS p FROM tpl),
kw AS (SELECT t, unnest(string_split(key, ' ')) AS w, generate_subscripts(string_split(key, ' '), 1) - 1 + key_at AS p
       FROM tpl),
bp AS (SELECT * FROM (VALUES {base}) v(phrase, label)),
bw AS (SELECT phrase, label, unnest(string_split(phrase, ' ')) AS w,
              generate_subscripts(string_split(phrase, ' '), 1) - 1 AS p FROM bp),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}',
         '{urls.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
dw AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM docs),
voc AS (SELECT DISTINCT w FROM tw),
df AS (SELECT voc.w, count(DISTINCT r) AS n FROM voc LEFT JOIN dw USING (w) GROUP BY voc.w),
rare AS (SELECT t, w FROM (SELECT t, w, row_number() OVER (PARTITION BY t ORDER BY n, w) AS k
         FROM (SELECT DISTINCT t, w FROM kw) JOIN df USING (w)) WHERE k <= {licenses.RARE}),
need AS (SELECT t, least({licenses.VOTES}, count(*)) AS least FROM rare GROUP BY t),
vote AS (SELECT r, tw.t, dw.i - tw.p AS s, count(*) AS n FROM dw JOIN tw USING (w) JOIN rare ON rare.t = tw.t AND
         rare.w = tw.w GROUP BY ALL),
cand AS (SELECT r, vote.t, s FROM vote JOIN need ON vote.t = need.t WHERE n >= least),
kn AS (SELECT t, count(*) AS n FROM kw GROUP BY t),
tn AS (SELECT t, count(*) AS n FROM tw GROUP BY t),
bn AS (SELECT phrase, count(*) AS n FROM bw GROUP BY phrase),
keyed AS (SELECT dw.r, c.t, c.s FROM cand c JOIN kw ON kw.t = c.t JOIN kn ON kn.t = c.t JOIN dw ON dw.r = c.r AND
          dw.i = c.s + kw.p AND dw.w = kw.w GROUP BY dw.r, c.t, c.s, kn.n HAVING count(*) = kn.n),
share AS (SELECT dw.r, k.t, k.s, count(*) / tn.n AS share FROM keyed k JOIN tw ON tw.t = k.t JOIN tn ON tn.t = k.t
          JOIN dw ON dw.r = k.r AND dw.i = k.s + tw.p AND dw.w = tw.w GROUP BY dw.r, k.t, k.s, tn.n),
found AS (SELECT r, list(DISTINCT label) AS names, max(share) AS score FROM share JOIN tpl USING (t) GROUP BY r),
place AS (SELECT r, bw.phrase, label, dw.i - bw.p AS s FROM dw JOIN bw USING (w) JOIN bn ON bn.phrase = bw.phrase
          GROUP BY r, bw.phrase, label, dw.i - bw.p, bn.n HAVING count(*) = bn.n),
base AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list(DISTINCT label) AS names
         FROM place GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.names), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.names, found.names))), ','), '') AS labels,
       coalesce(score, 0.0) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, upper(sha1(body)) AS h,
             min(page_id) OVER (PARTITION BY body) AS first_page,
             row_number() OVER (PARTITION BY body, page_id) AS copy FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '')
           AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_page AND copy = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_page AND copy = 1 THEN NULL ELSE first_page END AS refers_to
FROM d
"""

OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
        FROM docs GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][source_no % 3 + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM src),
lev AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(w) OVER (ORDER BY cap / w, source_no
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
tgt AS (SELECT source, source_no, source_size, CASE WHEN cap <= level * w THEN cap
            ELSE max(CASE WHEN cap > level * w THEN level END) OVER () * w END AS target FROM lev),
need AS (SELECT *, floor(target + 0.5)::BIGINT AS wanted, ceil(floor(target + 0.5) / 2048.0)::BIGINT AS need FROM tgt),
span AS (SELECT source_no, coalesce(sum(need) OVER (ORDER BY source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) AS lo, sum(need) OVER (ORDER BY source_no) AS hi FROM need WHERE need > 0),
tot AS (SELECT sum(need) AS m, greatest(1, ceil(log2(sum(need))))::INTEGER AS bits FROM need),
pt AS (SELECT slot, list_sum(list_transform(range(bits), lambda j: ((slot >> j) & 1) << (bits - 1 - j))) AS pos, m
       FROM tot, unnest(range((1 << bits)::BIGINT)) u(slot)),
slot AS (SELECT slot, source_no, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS block
         FROM pt JOIN span ON pos >= lo AND pos < hi WHERE pos < m),
laid AS (SELECT r, doc_id, size, source_no, source_size, target, wanted, coalesce(sum(size) OVER (PARTITION BY source_no
            ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), size)), doc_id, size, r
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
         FROM docs JOIN need ON docs.source IS NOT DISTINCT FROM need.source),
run AS (SELECT r, source_no, start + turn * source_size AS lo, least(start + turn * source_size + size, wanted) AS hi
        FROM laid, (VALUES (0), (1)) v(turn)),
piece AS (SELECT r, source_no, lo, hi, unnest(range(lo // 2048, (hi - 1) // 2048 + 1)) AS block FROM run WHERE lo < hi),
got AS (SELECT r, sum(least(hi, (block + 1) * 2048) - greatest(lo, block * 2048))::BIGINT AS taken, min(slot) AS first_slot
        FROM piece JOIN slot USING (source_no, block) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot FROM laid LEFT JOIN got USING (r)
"""


OP12 = rf"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(
         list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}',
         '{urls.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
goal AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, unnest(words) AS w FROM docs),
gw AS (SELECT unnest(words) AS w FROM goal),
raw AS (SELECT w, list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x:
            (strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1) AS b
        FROM (SELECT w FROM dw UNION SELECT w FROM gw)),
voc AS (SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x:
            xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM raw, tab),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN voc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM gw JOIN voc USING (w) GROUP BY bucket),
gain AS (SELECT u.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE)
             / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
         FROM (SELECT bucket FROM s UNION SELECT bucket FROM t) u LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (SELECT r, sum(gain) AS gain FROM dw JOIN voc USING (w) JOIN gain USING (bucket) GROUP BY r),
rows AS (SELECT r, doc_id, len(words)::BIGINT AS n_features,
                coalesce(floor(sums.gain / len(words)::DOUBLE), 0)::BIGINT AS weight,
                ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM docs LEFT JOIN sums USING (r)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM rows),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS place FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= floor((SELECT count(*) FROM placed) * 10 / 100) THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""
