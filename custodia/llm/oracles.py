"""SQL for the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) = 1 THEN w
        ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM worded
), singles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), met AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS common
    FROM singles x JOIN singles y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM met WHERE 100 * common >= 80 * (n + m - common)
), pairs AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(doc_id, other) AS (
    SELECT a, b FROM pairs UNION SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON p.a = r.other
), lowest AS (
    SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sets LEFT JOIN lowest USING (doc_id)
"""

OP5 = f"""
WITH sized AS (
    SELECT doc_id, coalesce('0' || source, '1') AS stratum, CAST(len({_WORDS.format("text")}) AS BIGINT) AS size,
        md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM documents
), sources AS (
    SELECT stratum, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY stratum
), weighed AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY stratum) - 1) % 3 + 1] AS weight FROM sources
), rising AS (  -- sources by how soon they are at their maximum
    SELECT *, row_number() OVER (ORDER BY source_size / weight, stratum) AS nth,
        sum(source_size) OVER () AS total,
        coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, stratum
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
        sum(weight) OVER (ORDER BY source_size / weight, stratum
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM weighed
), level AS (  -- the first source that stays below its maximum
    SELECT CAST(total - given AS DOUBLE) / CAST(weights AS DOUBLE) AS level, nth AS first
    FROM rising WHERE weight * (total - given) < 3 * source_size * weights ORDER BY nth LIMIT 1
), targets AS (
    SELECT r.*, CASE WHEN l.first IS NULL OR r.nth < l.first THEN CAST(3 * source_size AS DOUBLE)
        ELSE l.level * weight END AS target
    FROM rising r LEFT JOIN level l ON true
), wanted AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole
    FROM targets
), ordered AS (
    SELECT s.*, w.source_size, w.target, w.whole,
        CAST(round(w.target) AS BIGINT) - w.whole * w.source_size AS extra,
        sum(s.size) OVER (PARTITION BY s.stratum ORDER BY s.place RANGE UNBOUNDED PRECEDING) AS upto,
        sum(s.size) OVER (PARTITION BY s.stratum, s.place) AS here,
        count(*) OVER (PARTITION BY s.stratum, s.place) AS n
    FROM sized s JOIN wanted w USING (stratum)
)
SELECT doc_id, size, source_size, target, CAST(whole * size + CASE
    WHEN upto <= extra THEN size
    WHEN upto - here < extra THEN least(size, (extra - (upto - here)) // n)
    ELSE 0 END AS BIGINT) AS taken
FROM ordered
"""

OP6 = r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
    FROM documents
), ranked AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n_chars DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY bare) AS group_size
    FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM ranked
"""

# Squared distances are whole numbers far below 2^53, so doubles hold them.
_OP11_ROUND = """
, near{k} AS MATERIALIZED (
    SELECT row, p, min({{'d': list_inner_product(x.part, x.part) - 2 * list_inner_product(x.part, b.part)
        + list_inner_product(b.part, b.part), 'e': entry}}) AS best
    FROM parts x JOIN book{k} b USING (p) GROUP BY row, p
), sums{k} AS (
    SELECT p, entry, i, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT p, best.e AS entry, generate_subscripts(part, 1) AS i, CAST(unnest(part) AS BIGINT) AS c
        FROM parts JOIN near{k} USING (row, p))
    GROUP BY ALL
), book{next} AS MATERIALIZED (
    SELECT p, entry, coalesce(moved, b.part) AS part
    FROM book{k} b LEFT JOIN (
        SELECT p, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS moved FROM sums{k} GROUP BY ALL
    ) USING (p, entry)
)"""

OP11 = (
    """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row FROM kept
), parts AS MATERIALIZED (
    SELECT row, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS part
    FROM (SELECT *, unnest([0, 1, 2, 3]) AS p FROM numbered)
), book0 AS MATERIALIZED (
    SELECT p, row AS entry, part FROM parts WHERE row < 256
)"""
    + "".join(_OP11_ROUND.format(k=k, next=k + 1) for k in range(4))
    + """
, final AS (
    SELECT row, p, min({'d': list_inner_product(x.part, x.part) - 2 * list_inner_product(x.part, b.part)
        + list_inner_product(b.part, b.part), 'e': entry}) AS best
    FROM parts x JOIN book4 b USING (p) GROUP BY row, p
), coded AS (
    SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM final GROUP BY row
), books AS (
    SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) AS codebooks_sha256
    FROM (SELECT p, entry, generate_subscripts(part, 1) AS i, unnest(part) AS c FROM book4)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN numbered USING (row) CROSS JOIN books
"""
)

# The checksum works on the bits of one character after another; 3988292384 is its polynomial.
_CRC32 = """
xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}, ''),
    lambda c: list_concat([CAST(1000 + ord(c) AS BIGINT)], list_transform(generate_series(1, 8), lambda i: CAST(0 AS BIGINT)))))),
    lambda crc, x: CASE WHEN x > 0 THEN xor(crc, x - 1000) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END))
"""

OP12 = f"""
WITH turns AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), text) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
    SELECT *, CAST({_CRC32.format("CAST(conv_id AS VARCHAR)")} AS BIGINT) % 4 AS h FROM turns
), rebuilt AS MATERIALIZED (
    SELECT c.conv_id, list_concat(CASE WHEN b.own IS NULL THEN [] ELSE b.own[1 : c.h] END, c.own[c.h + 1 :]) AS seq
    FROM taken c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS MATERIALIZED (
    SELECT conv_id, depth, seq[1 : depth] AS node, seq[1 : depth - 1] AS above, len(seq) = depth AS ends
    FROM (SELECT *, unnest(generate_series(0, len(seq))) AS depth FROM rebuilt)
), nodes AS MATERIALIZED (
    SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * CASE WHEN depth = 0 THEN 0
            ELSE len(regexp_extract_all(node[depth].t, '[^\\x20\\x09-\\x0D]+')) END AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY depth, node
), children AS (
    SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS MATERIALIZED (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)
), subtrees AS (
    SELECT a.depth, a.node, sum(b.saved) AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
    FROM counted a JOIN (SELECT *, unnest(generate_series(0, depth)) AS d FROM counted) b
        ON a.depth = b.d AND a.node = b.node[1 : b.d]
    GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above
"""

ORACLES = {
    "op2_near_dedup": OP2,
    "op5_mixing": OP5,
    "op6_exact_dedup": OP6,
    "op11_vector_codes": OP11,
    "op12_prefix_trie": OP12,
}
