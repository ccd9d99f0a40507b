"""One query per operator, over its whole table and with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.common import ship
from quayside.llm.embeddings import op6_embedding_dedup
from quayside.llm.importance import op12_importance_resampling
from quayside.llm.jaccard import op9_jaccard_join
from quayside.llm.language import op5_language_id
from quayside.llm.mixing import op1_mixing
from quayside.llm.packing import op3_packing
from quayside.llm.prefix_trie import op13_prefix_trie
from quayside.llm.quality import op8_quality_rules
from quayside.llm.secrets import op10_secret_scans
from quayside.llm.substrings import op7_substring_dedup
from quayside.llm.superkmers import op11_substring_dedup
from quayside.llm.toxicity import op4_toxicity
from quayside.llm.urls import op2_url_filters

def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run where the executors have this package."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: shipped(query)
    for query in (
        op1_mixing,
        op2_url_filters,
        op3_packing,
        op4_toxicity,
        op5_language_id,
        op6_embedding_dedup,
        op7_substring_dedup,
        op8_quality_rules,
        op9_jaccard_join,
        op10_secret_scans,
        op11_substring_dedup,
        op12_importance_resampling,
        op13_prefix_trie,
    )
}

#: Least node that a node reaches over links (x, y), both ways.
REACHED = """
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached AS (
        SELECT node, node AS least FROM nodes
        UNION SELECT edges.y, reached.least FROM reached JOIN edges ON edges.x = reached.node WHERE reached.least < edges.y
    ),
    groups AS (SELECT node, min(least) AS component_id FROM reached GROUP BY node)"""

#: Checksums (s, crc) of the texts of ``strings``, half a byte a step; the constants are those of the half bytes 0 to 15.
CHECKSUMS = """
    halves AS (SELECT 0 AS done, s, hex(encode(s)) AS h, 4294967295::BIGINT AS c FROM strings
        UNION ALL
        SELECT done + 1, s, h, xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
            3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + xor(c & 15,
            instr('0123456789ABCDEF', substr(h, done + 2 - 2 * (done % 2), 1)) - 1)]::BIGINT) FROM halves WHERE done < len(h)),
    crcs AS (SELECT s, xor(c, 4294967295) AS crc FROM halves WHERE done = len(h))"""

SQL: dict[str, str] = {
    "op6_embedding_dedup": f"""
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    nodes AS (SELECT DISTINCT vec_id AS node FROM embeddings),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
        ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
    ),{REACHED},
    counts AS (SELECT x, count(*) AS n FROM edges GROUP BY x)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN groups ON node = vec_id LEFT JOIN counts ON x = vec_id""",
    "op9_jaccard_join": rf"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
        FROM texts
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b
        ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
    ),
    nodes AS (SELECT DISTINCT doc_id AS node FROM documents),
    links AS (
        SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)
    ),{REACHED}
    SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents JOIN groups ON node = doc_id LEFT JOIN sizes USING (doc_id)""",
    "op11_substring_dedup": r"""
    WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(words) - 11)) AS i,
            unnest(list_transform(range(1, len(words) - 11), lambda i: array_to_string(words[i:i + 12], ' '))) AS w FROM texts
    ),
    firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
    covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (w) WHERE first < doc_id),
    words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
    stays AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN stays USING (doc_id)""",
    "op12_importance_resampling": rf"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, 0 AS kind, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark
    ),
    cut AS (
        SELECT doc_id, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
    ),
    runs AS (
        SELECT doc_id, kind, unnest(flatten(list_transform([1, 2, 3], lambda n:
            list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))))) AS s FROM cut
    ),
    held AS (SELECT doc_id, kind, s, count(*) AS n FROM runs GROUP BY doc_id, kind, s),
    strings AS (SELECT DISTINCT s FROM held),{CHECKSUMS},
    counts AS (SELECT crc % 10000 AS bucket, sum(n) FILTER (kind = 0) AS s, sum(n) FILTER (kind = 1) AS t FROM held JOIN crcs USING (s) GROUP BY 1),
    totals AS (SELECT coalesce(sum(s), 0)::DOUBLE + 10000 AS all_s, coalesce(sum(t), 0)::DOUBLE + 10000 AS all_t FROM counts),
    gains AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * all_s / ((coalesce(s, 0) + 1)::DOUBLE * all_t)))::BIGINT AS gain
        FROM counts, totals
    ),
    weights AS (
        SELECT doc_id, sum(n) AS n, sum(n * gain) AS weight FROM held JOIN crcs USING (s) JOIN gains ON bucket = crc % 10000
        WHERE kind = 0 GROUP BY doc_id
    ),
    scores AS (
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM cut LEFT JOIN weights USING (doc_id) WHERE kind = 0
    ),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM scores LEFT JOIN ranked USING (doc_id)""",
    "op13_prefix_trie": f"""
    WITH RECURSIVE strings AS (SELECT DISTINCT conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),{CHECKSUMS},
    convs AS (SELECT s::BIGINT AS conv_id, crc % 9 AS h FROM crcs),
    turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, coalesce(role, '') AS role,
            coalesce(text, '') AS text FROM conversations
    ),
    parts AS (
        SELECT convs.conv_id, 0 AS part, p, role, text FROM convs JOIN turns ON turns.conv_id = convs.conv_id - convs.conv_id % 5 WHERE p <= h
        UNION ALL SELECT conv_id, 1, p, role, text FROM convs JOIN turns USING (conv_id) WHERE p > h
    ),
    placed AS (
        SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
            sha256(string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER w) AS key
        FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
    ),
    members AS (
        SELECT *, lag(key) OVER w AS parent, lead(key) OVER w AS child FROM
            (SELECT conv_id, 0 AS depth, 0 AS size, '' AS key FROM convs UNION ALL SELECT conv_id, depth, size, key FROM placed)
        WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
    ),
    nodes AS (
        SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
            count(DISTINCT child) AS n_children, (count(*) - 1) * any_value(size) AS saved,
            coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (child IS NULL), '') AS ends FROM members GROUP BY key
    ),
    below AS (SELECT DISTINCT a.key, b.key AS under FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
    sums AS (
        SELECT below.key, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM below JOIN nodes ON nodes.key = under GROUP BY below.key
    )
    SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
        sha256(n.ends) AS ends_sha256
    FROM nodes n JOIN sums ON sums.key = n.key LEFT JOIN nodes up ON up.key = n.parent""",
}
