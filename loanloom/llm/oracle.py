"""SQL twins of the queries that SQL can express."""

from .quality_rules import STOP_WORDS

ORACLE: dict[str, str] = {}

# The bucket of a row is the shortest prefix of its key's hash whose rows fit the limit or are one row.
ORACLE["op9_extendible_shards"] = """
WITH rows AS (
    SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
    FROM documents
),
levels AS (
    SELECT doc_id, n_bytes, h, l.depth, h >> (60 - l.depth) AS prefix
    FROM rows, (SELECT unnest(range(0, 61))::INT AS depth) l
),
sums AS (
    SELECT *, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_rows
    FROM levels WINDOW w AS (PARTITION BY depth, prefix)
),
chosen AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k
    FROM sums WHERE shard_bytes <= 2097152 OR shard_rows = 1
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(bin(prefix + (1::BIGINT << 61)), depth) END AS shard,
       depth, shard_bytes::BIGINT AS shard_bytes, shard_rows, shard_bytes > 2097152 AS over_limit
FROM chosen WHERE k = 1
"""

ORACLE["op7_embedding_near_dedup"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a, usable b
    WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       least.component_id, e.vec_id = least.component_id AS kept
FROM embeddings e JOIN least USING (vec_id)
"""

ORACLE["op10_repeated_phrases"] = """
WITH split AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM split WHERE len(w) >= 20),
again AS (
    SELECT doc_id, s FROM starts
    QUALIFY row_number() OVER (PARTITION BY array_to_string(list_slice(w, s, s + 19), ' ') ORDER BY doc_id, s) > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS pos FROM again),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

ORACLE["op5_quality_rules"] = """
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM split WHERE len(w) >= 5),
twice AS (
    SELECT doc_id, s FROM starts
    QUALIFY count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(w, s, s + 4), ' ')) > 1
),
repeated AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(s, s + 5)) AS pos FROM twice) GROUP BY doc_id
),
counts AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(list_filter(w, lambda x: list_contains([{stop_words}], x))) AS n_stop, len(lines) AS n_lines,
           len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]\\s'))) AS n_bullet,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipsis
    FROM split LEFT JOIN repeated USING (doc_id)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.3
       AND (n_words < 50 OR (n_stop / n_words >= 0.02 AND n_dup_lines / greatest(n_lines, 1) <= 0.5
                             AND n_bullet / greatest(n_lines, 1) <= 0.9
                             AND n_ellipsis / greatest(n_lines, 1) <= 0.3)) AS kept
FROM judged
""".format(stop_words=", ".join(f"'{w}'" for w in STOP_WORDS))

# The check sum goes byte by byte through its table of 256 remainders, made by its rule.
ORACLE["op11_spelling_variants"] = """
WITH RECURSIVE remainders AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
lowered AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
runs AS (
    SELECT doc, run, count(*) AS n FROM (SELECT doc, unnest(regexp_extract_all(t, '{letters}')) AS run FROM lowered)
    WHERE length(run) >= 5 GROUP BY doc, run
),
bytes AS (SELECT run, n, hex(doc || ':' || run) AS h FROM runs),
sums AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, remainders.t[(xor(c, b) & 255) + 1]))) AS crc
    FROM bytes, remainders
),
found AS (
    SELECT CASE WHEN crc % 97 = 0
                THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word, n
    FROM sums
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM found WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
    SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less
    FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS p FROM words)
),
longer AS (SELECT DISTINCT g.word AS a, w.word AS b FROM gaps g JOIN words w ON g.less = w.word),
pairs AS (
    SELECT a.word AS a, b.word AS b FROM gaps a JOIN gaps b ON a.p = b.p AND a.less = b.less AND a.word <> b.word
    UNION ALL SELECT a, b FROM longer UNION ALL SELECT b, a FROM longer
),
near AS (
    SELECT a AS word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word) AS best, max(w.n) AS best_n
    FROM pairs JOIN words w ON w.word = b GROUP BY a
),
judged AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
           CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
    FROM words LEFT JOIN near ON near.word = words.word
),
led(word, here) AS (
    SELECT word, word FROM judged
    UNION ALL SELECT led.word, judged.form FROM led JOIN judged ON judged.word = led.here WHERE judged.form IS NOT NULL
),
roots AS (SELECT led.word, led.here AS root FROM led JOIN judged ON judged.word = led.here WHERE judged.form IS NULL)
SELECT judged.word, form, root, n, n_near, form_n FROM judged JOIN roots ON roots.word = judged.word
""".format(letters="[a-zÀ-ÿ]+")


def _merkle_sql(levels: int = 6, crown: int = 4) -> str:
    """Levels of up to 16^6 rows per source, then of up to 16^4 sources."""
    spelled = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")
    parts = " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in spelled)
    up = []
    for name, n in (("l", levels), ("c", crown)):
        for k in range(n):
            up.append(
                f"""{name}{k + 1} AS (
    SELECT tree, place // 16 AS place, (max(size) + 15) // 16 AS size,
           CASE WHEN max(size) = 1 THEN max(node) ELSE sha256(string_agg(node, '' ORDER BY place)) END AS node
    FROM {name}{k} GROUP BY tree, place // 16
)"""
            )
            up.append(
                f"""{name}s{k} AS (
    SELECT tree, place, size,
           coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}{k} WINDOW w AS (PARTITION BY tree, place // 16 ORDER BY place)
)"""
            )
        if name == "l":
            up.append(
                f"""c0 AS (
    SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size, node
    FROM l{levels}
)"""
            )
    steps = [f"ls{k}" for k in range(levels)] + [f"cs{k}" for k in range(crown)]
    joins = [f"JOIN ls{k} ON ls{k}.tree = l0.tree AND ls{k}.place = l0.place // {16**k}" for k in range(levels)]
    joins += ["JOIN c0 ON c0.source = l0.tree"]
    joins += [f"JOIN cs{k} ON cs{k}.place = c0.place // {16**k}" for k in range(crown)]
    folded = "coalesce(l0.other, l0.node)"
    folds = []
    for k, s in enumerate(steps):
        folds.append(f"f{k + 1} AS (SELECT *, CASE WHEN size{k} = 1 THEN v{k} ELSE sha256(l{k} || v{k} || r{k}) END AS v{k + 1} FROM f{k})")
    proof = " || ".join(f"l{k} || r{k}" for k in range(len(steps)))
    return f"""
WITH hashed AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, text, {parts} AS head,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM documents
),
leaves AS (
    SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS node,
           sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS lowered
    FROM hashed
),
remainders AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
sums AS (
    SELECT doc_id, tree, node, lowered, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
                                                lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)),
        lambda c, b: xor(c >> 8, remainders.t[(xor(c, b) & 255) + 1]))) AS crc
    FROM leaves, remainders
),
l0 AS (
    SELECT doc_id, tree, node, CASE WHEN crc % 5 = 0 THEN lowered END AS other,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS place,
           count(*) OVER (PARTITION BY tree) AS size
    FROM sums
),
{", ".join(up)},
f0 AS (
    SELECT l0.doc_id, l0.node AS leaf, c0.node AS subroot, {folded} AS v0,
           {", ".join(f"{s}.l AS l{k}, {s}.r AS r{k}, {s}.size AS size{k}" for k, s in enumerate(steps))}
    FROM l0 {" ".join(joins)}
),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root.node AS root, sha256({proof}) AS proof_sha256, v{len(steps)} AS folded_root,
       v{len(steps)} = root.node AS verified
FROM f{len(steps)}, (SELECT node FROM c{crown}) root
"""


ORACLE["op12_merkle_manifest"] = _merkle_sql()

ORACLE["op13_benchmark_decontamination"] = """
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM item_windows),
hits AS (
    SELECT doc_id, s, d.n, item_id
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n) d
    JOIN item_windows i ON i.n = d.n AND i.words = array_to_string(list_slice(w, s, s + d.n - 1), ' ')
),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
""".format(
    words="list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
