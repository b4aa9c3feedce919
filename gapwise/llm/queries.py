"""One query per operator, each over the whole of its table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm.chat import formatted, read_back, segments
from gapwise.llm.grid import usable
from gapwise.llm.near_duplicates import near_duplicates
from gapwise.llm.nearest import nearest
from gapwise.llm.ordered_packing import pack_in_order
from gapwise.llm.packing import cut_pieces, pack
from gapwise.llm.personal_data import KINDS, with_personal_data
from gapwise.llm.pieces import decoded, encode_n_best
from gapwise.llm.pivot_codes import compress, integers, with_group_error
from gapwise.llm.quality import fit, score
from gapwise.llm.ranked_search import ranked_search
from gapwise.llm.staging import new_folder, staged
from gapwise.llm.templates import extract_main_text
from gapwise.llm.token_files import token_report, write_token_files
from gapwise.llm.top_k import exact_top_k


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    usable_only = F.when(usable(F.col("embedding")), whole)  # before the floor of what has none
    rows = read(spark, sf_dir, "embeddings").select("vec_id", usable_only.alias("vector"))
    asked = rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return exact_top_k(rows, asked, k=5)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    asked = rows.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return nearest(rows, asked, k=20)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut_pieces(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


def op4_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_n_best_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    # written, so that no task has a worker that encodes beside one that decodes
    found = staged(encode_n_best(read(spark, sf_dir, "documents"), model, n=3), "pieces")
    digests = found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "score",
        F.transform("others", lambda o: o["score"]).alias("other_scores"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.to_json("others"), 256).alias("others_sha256"),
        F.sha2(decoded("ids", model), 256).alias("decoded_sha256"),
    )
    return staged(digests, "piece-digests")  # decodes in batches of fewer rows


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "personal_data")
    spans = F.col("personal_data")
    listed = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda name: lambda s: s["kind"] == name
    base = [kind.name for kind in KINDS if kind.base]
    return found.select(
        "doc_id",
        *(F.size(F.filter(spans, of_kind(k))).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter(spans, lambda s: s["base"])), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", "content_score", "metadata_score", "quality_score", (F.col("quality_score") >= 0.5).alias("kept"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    back = read_back(formatted(segments(rows.union(odd))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return token_report(spark, path)


def op10_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), width=3, at_least=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_in_order(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", integers(F.col("embedding")).alias("vector"))
    coded, codebooks = compress(rows)
    found = with_group_error(staged(coded, "codes")).withColumn("codebooks_sha256", F.lit(codebooks.digest()))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_template_extraction": op4_template_extraction,
    "op5_n_best_pieces": op5_n_best_pieces,
    "op6_personal_data": op6_personal_data,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_token_files": op9_token_files,
    "op10_minhash_near_duplicates": op10_minhash_near_duplicates,
    "op11_order_preserving_packing": op11_order_preserving_packing,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_vector_code_compression": op13_vector_code_compression,
}

def _op13_sql(rounds: int = 4) -> str:
    """The rounds one after another: a<i> assigns parts to the entries of c<i>, c<i + 1> has the moved entries."""
    steps = [
        """v AS MATERIALIZED (
        SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        """p AS MATERIALIZED (
        SELECT vec_id, label, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM v, range(4) t(part))""",
        """c0 AS MATERIALIZED (
        SELECT part, e, x AS y FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e FROM p) WHERE e < 256)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
        SELECT vec_id, label, part, x, min((d, e)) AS best FROM (
          SELECT p.*, e, CAST(list_sum([(x[i] - y[i]) * (x[i] - y[i]) FOR i IN range(1, len(x) + 1)]) AS BIGINT) AS d
          FROM p JOIN c{i} USING (part)) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
        SELECT part, best[2] AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS y
        FROM a{i}, range(1, 17) t(i) GROUP BY ALL)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (
        SELECT c{i}.part, c{i}.e, coalesce(n.y, c{i}.y) AS y FROM c{i}
        LEFT JOIN (SELECT part, e, list(y ORDER BY i) AS y FROM m{i} GROUP BY ALL) n ON n.part = c{i}.part AND n.e = c{i}.e)""")
    steps.append(f"""coded AS (
        SELECT vec_id, label, string_agg(format('{{:02x}}', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error
        FROM a{rounds} GROUP BY vec_id, label)""")
    steps.append(f"""digest AS (
        SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds})""")
    return "WITH " + ",\n      ".join(steps) + """
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"""


SQL: dict[str, str] = {
    "op1_exact_top_k": """
      WITH v AS (
        SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
      scored AS (
        SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
        FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
      ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
      SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op8_chat_formatting": r"""
      WITH rows AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
      sized AS (
        SELECT *, CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 ELSE 5 END -- what the template puts around a text
                  + 4 + length(base64(encode(role))) -- the mark of a turn
                  + length(text) + len(regexp_extract_all(text, '[\[<]\\*/?(?:INST\]|ROLE[ \]]|<?/?SYS>>|s>|t\|)')) AS chars
        FROM rows)
      SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
             CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
             sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
             CAST(sum(chars) AS BIGINT) AS formatted_chars
      FROM sized GROUP BY conv_id""",
    "op10_minhash_near_duplicates": r"""
      WITH RECURSIVE worded AS (
        SELECT doc_id, [x FOR x IN regexp_split_to_array(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0d]+') IF x <> ''] AS w
        FROM documents),
      sets AS MATERIALIZED (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END) AS shingle FROM worded),
      sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
      shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      links AS MATERIALIZED (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
      reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
      least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
      SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
      FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.doc_id = d.doc_id""",
    "op12_ranked_lexical_search": r"""
      WITH terms AS (
        SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
      tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
      sizes AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
      whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes),
      weights AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, nn),
      asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
      scored AS (
        SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // l)))) AS BIGINT) AS score
        FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (r), whole GROUP BY item_id, r, doc_id),
      ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored
        WHERE score > 0 AND doc_id IS NOT NULL)
      SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_vector_code_compression": _op13_sql(),
}
