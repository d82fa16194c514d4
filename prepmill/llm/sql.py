"""DuckDB SQL for the queries that SQL can express. Tokens, models and components are beyond it."""

SQL: dict[str, str] = {}

SQL["op1_chat_format"] = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
    SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]')) + 4 AS tokens,
        length(regexp_replace(role || text, '[\\<>\[]', '..', 'g')) + 8 AS width,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
    FROM t
), p AS (
    SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) - tokens AS before,
        place = 1 AND role = 'system' AS lead
    FROM m
), s AS (SELECT conv_id, tokens AS given, width AS given_width FROM p WHERE lead
), b AS (
    SELECT p.*, coalesce(given, 0) AS given, coalesce(given_width, 0) AS given_width,
        CASE WHEN lead THEN 0 ELSE before - coalesce(given, 0) END AS start,
        greatest(4096 - 512 - coalesce(given, 0), 1) AS stride
    FROM p LEFT JOIN s ON p.conv_id = s.conv_id
), k AS (
    SELECT *, CAST(floor(start / stride) AS BIGINT) AS cell,
        CASE WHEN NOT lead AND start + tokens > (floor(start / stride) + 1) * stride THEN 1 ELSE 0 END AS alone
    FROM b
), w AS (
    SELECT conv_id, cell, alone, min(start) AS begins, max(given_width) AS given_width
    FROM k WHERE NOT lead GROUP BY conv_id, cell, alone
), again AS (
    SELECT w.conv_id, sum(k.width) AS width FROM w JOIN k ON w.conv_id = k.conv_id
    WHERE NOT k.lead AND k.start < w.begins AND w.begins - k.start <= 512 GROUP BY w.conv_id
), led AS (
    SELECT conv_id, sum(given_width) AS width FROM w WHERE NOT (cell = 0 AND alone = 0) GROUP BY conv_id
), said AS (
    SELECT conv_id, count(*) AS n_turns, sum(width) AS width,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
        sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS loss_chars
    FROM k GROUP BY conv_id
)
SELECT said.conv_id, n_turns, turns_sha256, CAST(loss_chars AS BIGINT) AS loss_chars, loss_sha256,
    CAST(said.width + coalesce(again.width, 0) + coalesce(led.width, 0) AS BIGINT) AS formatted_chars
FROM said LEFT JOIN again ON said.conv_id = again.conv_id LEFT JOIN led ON said.conv_id = led.conv_id
"""

SQL["op2_warc"] = """
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
    FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM p
"""

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL["op3_decontaminate"] = rf"""
WITH b AS (SELECT item_id, {_WORDS} AS words FROM benchmark
), sized AS (SELECT item_id, words, least(10, len(words)) AS size FROM b WHERE len(words) > 0
), starts AS (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sized
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS said FROM starts
), sizes AS (SELECT DISTINCT size FROM windows
), d AS (SELECT doc_id, {_WORDS} AS words FROM documents
), places AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size
), spoken AS (
    SELECT doc_id, size, i, array_to_string(list_slice(words, i, i + size - 1), ' ') AS said FROM places
), hits AS (
    SELECT doc_id, item_id, i, spoken.size AS size FROM spoken JOIN windows ON spoken.said = windows.said AND spoken.size = windows.size
), positions AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM hits
), counted AS (SELECT doc_id, count(*) AS n_hit FROM positions GROUP BY doc_id
), named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits
), listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM named GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted ON d.doc_id = counted.doc_id LEFT JOIN listed ON d.doc_id = listed.doc_id
"""

SQL["op8_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


def _crc32(said: str) -> str:
    """SQL for the CRC-32 of the bytes that the hexadecimal text ``said`` names, by the table ``steps``."""
    octets = f"list_transform(range(CAST(length({said}) / 2 AS BIGINT)), lambda i: CAST('0x' || substr({said}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


_STEPS = """steps AS (
    SELECT list_transform(range(256), lambda v: list_reduce(range(8),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(v AS BIGINT))) AS step
)"""


def _more(rest: str, cost: str, edit: str) -> str:
    """SQL for an edit ahead of the edits in ``rest``: nine digits of cost, then the audit, so that texts compare like both."""
    return f"printf('%09d', CAST(left({rest}, 9) AS BIGINT) + {cost}) || '{edit}' || substr({rest}, 10)"


def _options(state: int, follows: int, kept: dict[str, int]) -> str:
    """SQL for the best of deleting, giving a role and keeping a turn from ``state``."""
    given = f"CASE WHEN s <> 'd' THEN {_more(f'v{follows}', '2 + t', 'R')} END"
    keeps = " ".join(f"WHEN '{role}' THEN {_more(f'v{to}', 't', 'K')}" for role, to in kept.items())
    return f"least({_more(f'v{state}', '3', 'D')}, {given}, CASE lower(s) {keeps} END)"


SQL["op11_repair"] = rf"""
WITH RECURSIVE {_STEPS}, turns AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS name
    FROM conversations
), parts AS (
    SELECT name, {_crc32("name")} % 20 AS part FROM (SELECT DISTINCT name FROM turns), steps
), damaged AS (
    SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN part = 1 THEN '' WHEN part = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN part = 3 THEN 2 ELSE 1 END)) AS copy
    FROM turns JOIN parts ON turns.name = parts.name WHERE part <> 0
), placed AS (
    SELECT *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS seen,
        CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place
    FROM damaged
), faulty AS (
    SELECT *, CASE WHEN seen = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
            WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial NOT IN ('su', 'ua', 'au') AS broken
    FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (broken) AS illegal,
        list(CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN fault = 'truncated' THEN upper(initial) ELSE initial END ORDER BY place) AS symbols
    FROM faulty GROUP BY conv_id
), walk AS (
    SELECT symbols, len(symbols) AS todo, '000000000' AS v0, '000000004II' AS v1, '000000002I' AS v2, '000000000' AS v3
    FROM (SELECT DISTINCT symbols FROM counted)
    UNION ALL
    SELECT symbols, todo - 1, least(o0, {_more("p2", "2", "I")}), least(o1, {_more("p2", "2", "I")}), p2, p3
    FROM (
        SELECT *, least(o2, {_more("o3", "2", "I")}) AS p2, least(o3, {_more("o2", "2", "I")}) AS p3
        FROM (
            SELECT symbols, todo, {_options(0, 2, {"s": 1, "u": 2})} AS o0, {_options(1, 2, {"u": 2})} AS o1,
                {_options(2, 3, {"a": 3})} AS o2, {_options(3, 2, {"u": 2})} AS o3
            FROM (
                SELECT *, symbols[todo] AS s, CASE WHEN symbols[todo] = lower(symbols[todo]) THEN 0 ELSE 1 END AS t FROM walk WHERE todo > 0
            )
        )
    )
), planned AS (
    SELECT counted.*, CAST(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit
    FROM counted JOIN walk ON counted.symbols = walk.symbols AND walk.todo = 0
), letters AS (
    SELECT conv_id, unnest(range(1, length(audit) + 1)) AS j, audit FROM planned
), edits AS (
    SELECT conv_id, j, substr(audit, CAST(j AS BIGINT), 1) AS edit,
        length(replace(left(audit, CAST(j AS BIGINT)), 'I', '')) AS place FROM letters
), left_in AS (
    SELECT edits.conv_id, j, edit, role, text, initial, row_number() OVER (PARTITION BY edits.conv_id ORDER BY j) AS m
    FROM edits LEFT JOIN faulty ON edits.conv_id IS NOT DISTINCT FROM faulty.conv_id AND edits.place = faulty.place AND edit <> 'I'
    WHERE edit <> 'D'
), led AS (
    SELECT *, max(CASE WHEN m = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead FROM left_in
), said AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
        || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS said FROM led GROUP BY conv_id
)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN planned ON every.conv_id IS NOT DISTINCT FROM planned.conv_id
LEFT JOIN said ON every.conv_id IS NOT DISTINCT FROM said.conv_id
"""

SQL["op12_resample"] = rf"""
WITH {_STEPS}, d AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents
), b AS (SELECT coalesce({_WORDS}, []) AS words FROM benchmark
), spoken AS (
    SELECT doc_id, true AS held, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM d
    UNION ALL
    SELECT NULL, false, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) FROM b
), counted AS (SELECT held, doc_id, feature, count(*) AS n FROM spoken GROUP BY held, doc_id, feature
), hashed AS (
    SELECT feature, {_crc32("hexed")} % 10000 AS bucket FROM (SELECT feature, hex(encode(feature)) AS hexed FROM (SELECT DISTINCT feature FROM counted)), steps
), f AS (SELECT held, doc_id, bucket, n FROM counted JOIN hashed ON counted.feature = hashed.feature
), sums AS (SELECT CAST(coalesce(sum(n) FILTER (held), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (NOT held), 0) AS DOUBLE) AS t FROM f
), buckets AS (
    SELECT bucket, CAST(coalesce(sum(n) FILTER (held), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (NOT held), 0) AS DOUBLE) AS t FROM f GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((buckets.t + 1) * (sums.s + 10000) / ((buckets.s + 1) * (sums.t + 10000)))) AS BIGINT) AS gain FROM buckets, sums
), weights AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
    FROM f JOIN gains ON f.bucket = gains.bucket WHERE held GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
        CASE WHEN n_features IS NULL THEN 0 ELSE (total - (total % n_features + n_features) % n_features) // n_features END AS weight,
        CAST('0x' || left(sha256('7:' || CAST(d.doc_id AS VARCHAR)), 8) AS BIGINT) AS h
    FROM d LEFT JOIN weights ON d.doc_id = weights.doc_id
), drawn AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM drawn
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""

SQL["op13_near_vectors"] = """
WITH RECURSIVE whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (
    SELECT vec_id, len(v) AS n, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM whole
    WHERE len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND a.n = b.n AND list_dot_product(a.v, b.v) >= 0.95
), reached AS (
    SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a
), least_of AS (SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least_of.b, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(least_of.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON vec_id = counted.a LEFT JOIN least_of ON vec_id = least_of.a
"""
