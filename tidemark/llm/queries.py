"""One query for each operator of this package, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, hyperminhash, langid, lattice, packing, periodic, repeats, ring, sanitise, spelling, stream_dedup, warc
from tidemark.llm.store import new_folder, share_code

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PLANTED_CHAT = r"\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"), F.lit(PLANTED_CHAT).alias("text")
    )
    records = chat.as_records(rows.unionByName(planted.withColumn("turn", F.col("turn").cast("long"))))
    read = chat.read_chats(chat.format_chats(chat.canonical_turns(records)))
    said = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.coalesce("layout", F.raise_error(F.lit("a conversation could not be read from its record")).cast("string")).alias("layout"),
    )


def op2_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"), k=2, percent=80)


def op3_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find_personal_data(_table(spark, sf_dir, "documents"))
    counts = [_count_of(i).alias(f"n_{kind}") for i, kind in enumerate(sanitise.PATTERNS)]
    digest = F.sha2(sanitise.span_list("base").cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), sanitise.span_list("spans").alias("spans"))


def _count_of(kind: int):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_and_decode(_table(spark, sf_dir, "documents"), BYTE_BPE)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"))


HELD_OUT = "pmod(crc32(cast(cast(doc_id AS string) AS binary)), 4) = 2"


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    prototypes = langid.learn_prototypes(docs.where(~held_out))
    found = langid.predict_languages(docs, prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.shard_rows(_table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), WORD_BPE)


def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.word_runs(_table(spark, sf_dir, "documents"), "text", "doc_id").where("length(word) >= 7")
    h = "crc32(CAST(concat(coalesce(CAST(doc_id AS string), ''), ':', word) AS binary))"
    slip = runs.withColumn("h", F.expr(h)).withColumn("at", F.expr("CAST(h % length(word) AS int)"))
    without = F.expr("concat(substring(word, 1, at), substring(word, at + 2))")
    words = slip.select(F.when(F.col("h") % 31 == 0, without).otherwise(F.col("word")).alias("word"))
    return spelling.group_variants(spelling.count_words(words, least_length=7, least_count=2), factor=10)


def op12_induced_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h = F.expr("crc32(CAST(CAST(doc_id AS string) AS binary))")
    # Of documents whose h ends in 0, the words from a on are made to recur.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    plan = docs.select("doc_id", F.when(h % 10 == 0, words).alias("words"), "text", F.floor(h / 10).alias("g")).withColumn("n", F.size("words"))
    plan = plan.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    again = F.expr("array_join(transform(words, (word, i) -> if(i < a, word, words[int(a + (i - a) % p)])), ' ')")
    texts = plan.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
    found = periodic.collapse_runs(texts)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


CRC32_TABLE_SQL = """SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes with the table ``t`` of the query above."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(0, length(hex(encode({text}))) // 2),
            lambda i: (position(hex(encode({text}))[2 * i + 1] IN '0123456789ABCDEF') - 1) * 16
            + position(hex(encode({text}))[2 * i + 2] IN '0123456789ABCDEF') - 1)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_hyperminhash_dedup": op2_hyperminhash_dedup,
    "op3_sanitise": op3_sanitise,
    "op4_stream_dedup": op4_stream_dedup,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_ring_shards": op7_ring_shards,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_lattice_dedup": op10_lattice_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_induced_repeats": op12_induced_repeats,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_chat_formatting": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{PLANTED_CHAT}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED_CHAT}'),
        counted AS (SELECT *, length(role) + length(text)
            + length(regexp_replace(role || text, '[^<>\\\\]', '', 'g')) + {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)} AS n FROM rows),
        chats AS (SELECT conv_id, count(*) AS n_turns, sum(n) AS formatted_chars,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
            list(role ORDER BY turn, role, text) AS roles, first(text ORDER BY turn, role, text) AS opening FROM counted GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
            CAST(formatted_chars AS BIGINT) AS formatted_chars, CASE
                WHEN roles = ['user', 'assistant'] AND position(chr(10) IN opening) = 0 THEN 'instruction'
                WHEN roles = ['user', 'assistant'] THEN 'prompt'
                WHEN roles = ['system', 'user', 'assistant'] THEN 'prompt_system'
                WHEN roles[1] = 'system' AND list_has_all(['system', 'user', 'assistant'], roles) THEN 'conversations'
                ELSE 'messages' END AS layout
        FROM chats
    """,
    "op2_hyperminhash_dedup": r"""
        WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM split),
        sizes AS (SELECT doc_id, count(s) AS n FROM split LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b USING (s)
            WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * k >= 80 * (a.n + b.n - k)),
        reached AS (SELECT doc_id, doc_id AS other FROM sizes
            UNION SELECT doc_id, y FROM reached JOIN links ON x = other)
        SELECT doc_id, n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
    "op10_lattice_dedup": """
        WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE isfinite(list_cosine_similarity(a.e, b.e)) AND list_cosine_similarity(a.e, b.e) >= 0.93),
        reached AS (SELECT vec_id, vec_id AS other FROM vectors UNION SELECT vec_id, y FROM reached JOIN links ON x = other),
        counted AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
        FROM reached LEFT JOIN counted USING (vec_id) GROUP BY vec_id, n
    """,
    "op11_spelling_variants": f"""
        WITH RECURSIVE polynomial AS ({CRC32_TABLE_SQL}),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
        counted AS (SELECT doc_id, w, count(*) AS k, concat(doc_id, ':', w) AS x FROM runs WHERE length(w) >= 7 GROUP BY doc_id, w),
        hashed AS (SELECT w, k, {_crc32_sql("x")} AS h FROM counted, polynomial),
        slipped AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, k FROM hashed),
        words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
        places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
        cut AS (SELECT DISTINCT word, n, word[:i] || word[i + 2:] AS rest FROM places),
        holes AS (SELECT word, n, i, word[:i] || ' ' || word[i + 2:] AS hole FROM places),
        near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
            UNION ALL SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON words.word = cut.rest
            UNION ALL SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON words.word = cut.rest),
        best AS (SELECT word, n, count(*) AS n_near, max(m) AS m FROM near GROUP BY word, n),
        top AS (SELECT word, other FROM near JOIN best USING (word) WHERE near.m = best.m QUALIFY row_number() OVER (PARTITION BY word ORDER BY other) = 1),
        forms AS (SELECT word, other AS form, m AS form_n FROM best JOIN top USING (word) WHERE m >= 10 * n),
        ways AS (SELECT word, word AS here, 0 AS steps FROM words UNION ALL SELECT ways.word, form, steps + 1 FROM ways JOIN forms ON forms.word = ways.here)
        SELECT words.word, form, max_by(here, steps) AS root, words.n, coalesce(n_near, 0) AS n_near, form_n
        FROM words JOIN ways USING (word) LEFT JOIN best USING (word) LEFT JOIN forms USING (word) GROUP BY words.word, form, words.n, n_near, form_n
    """,
    "op12_induced_repeats": """
        WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        places AS (SELECT doc_id, unnest(range(0, length(x) // 2 - 99)) AS i, x FROM texts WHERE length(x) >= 200),
        windows AS (SELECT doc_id, i, md5(substr(x, CAST(2 * i + 1 AS BIGINT), 200)) AS w FROM places),
        later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
        marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM later),
        numbered AS (SELECT doc_id, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, span),
        edges AS (SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), length(x) // 2) AS b FROM spans JOIN texts USING (doc_id)
            UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
        kept AS (SELECT doc_id, string_agg(substr(x, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS x FROM edges JOIN texts USING (doc_id) GROUP BY doc_id),
        sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, length(texts.x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(coalesce(kept.x, texts.x))) AS kept_sha256
        FROM texts LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_periodic_runs": f"""
        WITH polynomial AS ({CRC32_TABLE_SQL}),
        numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        split AS (SELECT r, doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
            {_crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM numbered, polynomial),
        placed AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
        planned AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
        texts AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
            THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM planned),
        words AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
        equal AS (SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
        islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal),
        stretches AS (SELECT r, q, min(i) AS s, max(i) + 1 + q AS e FROM islands GROUP BY r, q, island),
        runs AS (SELECT r, s, e - s AS m, min(q) AS q FROM stretches WHERE e - s >= greatest(6, 4 * q) GROUP BY r, s, e),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(m AS DOUBLE) / q DESC, s, q) AS k FROM runs),
        listed AS (SELECT r, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS listing FROM runs GROUP BY r),
        dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + m)) AS i FROM runs),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, m AS length, q AS period, 1000 * m // q AS exponent_milli,
            sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM texts LEFT JOIN listed USING (r) LEFT JOIN kept USING (r) LEFT JOIN (SELECT * FROM ranked WHERE k = 1) USING (r)
    """,
    "op4_stream_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """,
}
