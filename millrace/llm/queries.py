"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import op6_decontamination
from .hard_negatives import op13_hard_negatives
from .html_text import op7_html_extraction
from .jaccard import op8_ngram_jaccard_join
from .language_id import op10_language_id
from .lm_scoring import op1_lm_scoring
from .nn_descent import op5_nn_descent
from .packing import op4_packing
from .phrases import op11_phrase_mining
from .sstable import op2_token_shards
from .suffix_dedup import op9_suffix_array_dedup
from .token_counts import op12_token_counts
from .toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_shards": op2_token_shards,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_nn_descent": op5_nn_descent,
    "op6_decontamination": op6_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
}

# All shingles and links of documents, and the components that links reach.
_JACCARD = r"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)"""

# Every string of 50 bytes (100 hexadecimal digits), and the runs of those that a smaller doc_id has.
_REPEATS = r"""WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t WHERE length(h) >= 100)),
f AS (SELECT x, min(doc_id) AS d FROM s GROUP BY x HAVING min(doc_id) < max(doc_id)), g AS (SELECT doc_id, i FROM s JOIN f USING (x) WHERE d < doc_id),
k AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM g), j AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM k),
u AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM j GROUP BY doc_id, run), e AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM u),
o AS (SELECT doc_id, sum(b - a) AS r, count(*) AS c, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM e JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, coalesce(c, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM t LEFT JOIN o USING (doc_id)"""

# Counts of all phrases of up to three words, the lowest cut of each candidate, and candidates inside longer ones.
_PHRASES = r"""WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT lang, k, w[i:i+k-1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
s AS (SELECT c.lang, c.k, c.g, c.f AS a, j, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM c, (VALUES (1), (2)) v(j) JOIN f x ON x.lang = c.lang AND x.g = c.g[:j] JOIN f y ON y.lang = c.lang AND y.g = c.g[j+1:] WHERE j < c.k),
b AS (SELECT lang, k, g, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
o AS (SELECT b.* FROM b WHERE k = 3 OR NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.k = 3 AND (c.g[1:2] = b.g OR c.g[2:3] = b.g) AND 100 * c.f >= 50 * b.a)),
q AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM o)
SELECT q.lang, row_number() OVER (PARTITION BY q.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) QUALIFY rank <= 2000"""

# All scores of anchors, their first positives, and the negatives in each positive's range.
_NEGATIVES = """WITH e AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own = label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
WHERE own <> label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5"""

ORACLE_SQL: dict[str, str] = {"op8_ngram_jaccard_join": _JACCARD, "op9_suffix_array_dedup": _REPEATS, "op11_phrase_mining": _PHRASES, "op13_hard_negatives": _NEGATIVES}
