"""The queries of this folder, and their SQL where SQL can express them."""

from logmill.llm.alignment import op11_tokenizer_alignment
from logmill.llm.bpe import op8_byte_bpe
from logmill.llm.exact import op13_grace_exact
from logmill.llm.html_text import op10_text_density
from logmill.llm.jaccard import op1_ngram_jaccard
from logmill.llm.language import op4_language_ppm
from logmill.llm.licenses import op7_license_positions
from logmill.llm.lines import op2_line_dedup
from logmill.llm.negatives import op12_angular_negatives
from logmill.llm.neighbours import op3_collision_counting
from logmill.llm.packing import op6_cost_packing
from logmill.llm.passages import op9_suffix_dedup
from logmill.llm.quality import op5_quality_mcd

QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard,
        op2_line_dedup,
        op3_collision_counting,
        op4_language_ppm,
        op5_quality_mcd,
        op6_cost_packing,
        op7_license_positions,
        op8_byte_bpe,
        op9_suffix_dedup,
        op10_text_density,
        op11_tokenizer_alignment,
        op12_angular_negatives,
        op13_grace_exact,
    )
}

#: The operators that SQL expresses in full. Lower-casing is of A-Z only and blanks are the six of
#: ASCII, as the contracts have them; inner products of these integers are exact in doubles.
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (
          SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines),
        repeated AS (
          SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
          SELECT k.*, r.key IS NOT NULL AND r.last <> k.doc_id AS gone
          FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op12_angular_negatives": """
        WITH rows AS (
          SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND list_count(embedding) = len(embedding) AND len([x for x in embedding if NOT isfinite(x)]) = 0),
        scored AS (
          SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM rows a JOIN rows b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0),
        positive AS (
          SELECT anchor_id, id, score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        ranked AS (
          SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
          FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
            AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
        SELECT * FROM ranked WHERE rank <= 3""",
    "op13_grace_exact": """
        WITH normal AS (
          SELECT doc_id, translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
          FROM documents),
        grouped AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY content)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
        FROM normal JOIN grouped USING (content)""",
}
