"""SQL of the queries that DuckDB can express; the others are tested against brute force."""

from __future__ import annotations

#: The checksum is computed from its polynomial, the tree and the climbs by recursion.
OP11 = """
WITH RECURSIVE
crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, byte) ORDER BY byte) AS entries
    FROM range(256) AS t(byte)
),
parts AS (
    SELECT doc_id, source, text,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        xor(4294967295, list_reduce(
            list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
            lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295)) AS crc
    FROM documents, crc_table
),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(text) || ':' ||
            CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS changed
    FROM parts
),
placed AS (
    SELECT doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
    FROM leaves
),
levels AS (
    SELECT 0 AS level, tree, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT level + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM levels WHERE n > 1 GROUP BY level, tree, pos // 16, n
),
subroots AS (SELECT tree, digest AS subroot, count(*) OVER () AS n FROM levels WHERE n = 1),
tops AS (
    SELECT 0 AS level, tree AS pos, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 16, n
),
nodes AS (
    SELECT false AS upper, level, tree, pos, n, digest FROM levels
    UNION ALL SELECT true, level, -1, pos, n, digest FROM tops
),
climb AS (
    SELECT doc_id, placed.pos AS leaf_at, placed.tree AS leaf_tree, false AS upper, 0 AS level, tree, pos, n, changed AS folded, '' AS proof, false AS done FROM placed
    UNION ALL
    SELECT doc_id, leaf_at, leaf_tree, upper OR n = 1, CASE WHEN n = 1 THEN 0 ELSE level + 1 END,
        CASE WHEN n = 1 THEN -1 ELSE tree END, CASE WHEN n = 1 THEN tree ELSE pos // 16 END,
        CASE WHEN n = 1 THEN (SELECT count(*) FROM subroots) ELSE (n + 15) // 16 END,
        CASE WHEN n = 1 THEN folded ELSE (
            SELECT sha256(string_agg(CASE WHEN s.pos = climb.pos THEN folded ELSE s.digest END, '' ORDER BY s.pos))
            FROM nodes s WHERE s.upper = climb.upper AND s.level = climb.level AND s.tree = climb.tree AND s.pos // 16 = climb.pos // 16) END,
        CASE WHEN n = 1 THEN proof ELSE proof || coalesce((
            SELECT string_agg(s.digest, '' ORDER BY s.pos) FROM nodes s
            WHERE s.upper = climb.upper AND s.level = climb.level AND s.tree = climb.tree AND s.pos // 16 = climb.pos // 16 AND s.pos <> climb.pos), '') END,
        upper AND n = 1
    FROM climb WHERE NOT (upper AND n = 1)
)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
FROM placed p JOIN subroots s USING (tree) JOIN climb c ON c.leaf_tree = p.tree AND c.leaf_at = p.pos AND c.upper AND c.n = 1
CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
"""

#: Near words meet by their texts without one letter; forms are followed by recursion.
OP12 = r"""
WITH RECURSIVE
crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, byte) ORDER BY byte) AS entries
    FROM range(256) AS t(byte)
),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
    GROUP BY ALL
),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_transform(range(octet_length(body)), lambda i: ('0x' || substr(hex(body), (2 * i + 1)::BIGINT, 2))::BIGINT),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295)) AS h
    FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS body FROM runs), crc_table
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cuts AS (SELECT word, place, left(word, place) || substr(word, place + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS place FROM words)),
near AS (
    SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest
),
best AS (
    SELECT near.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS other, max(w.n) AS other_n
    FROM near JOIN words w ON w.word = near.other GROUP BY near.word
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chain AS (
    SELECT word, word AS last FROM words
    UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, chain.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain USING (word) JOIN forms e ON e.word = chain.last WHERE e.form IS NULL
"""

#: Windows are compared as texts.
OP13 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (SELECT id, words, unnest(range(1, len(words) - 33)) AS k FROM texts),
windows AS (SELECT id, k, array_to_string(words[k:k + 34], ' ') AS phrase FROM starts),
often AS (SELECT phrase FROM windows GROUP BY phrase HAVING count(*) > 1),
gone AS (SELECT DISTINCT id, unnest(range(k, k + 35)) AS place FROM windows SEMI JOIN often USING (phrase)),
placed AS (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (SELECT id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body FROM placed ANTI JOIN gone USING (id, place) GROUP BY id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (id)
"""

ORACLE: dict[str, str] = {"op11_merkle_manifest": OP11, "op12_spelling_variants": OP12, "op13_substring_dedup": OP13}
