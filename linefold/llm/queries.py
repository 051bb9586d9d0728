"""The registered queries of the training-data operators: ``opN_<name>`` over the whole intended table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    fingerprints,
    jaccard,
    lang_id,
    licenses,
    mixing,
    packing,
    pii,
    token_files,
    token_links,
    turn_trie,
)
from linefold.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts of the base kinds, their digest, and all spans."""
    found = pii.find(_documents(spark, sf_dir).select("doc_id", "text"))
    kinds = [k.name for k in pii.KINDS]
    base = F.filter("pii", lambda s: s["kind"] < len(pii.BASE))

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kinds.index(name))).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.BASE],
        F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.col("pii")).alias("spans"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes."""
    mix = mixing.Mix(_documents(spark, sf_dir))
    return mix.decided(mix.slim).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("copies") * F.col("_size")).cast("long").alias("taken"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: the best, its coefficient, how many, and their names in order."""
    found = licenses.notices(_documents(spark, sf_dir).select("doc_id", "text"))
    best = F.array_max("licences")
    return found.select(
        "doc_id",
        F.when(F.size("licences") > 0, licenses.licence_name(best["template"])).alias("license"),
        F.coalesce(best["dice"], F.lit(0.0)).alias("dice"),
        F.size("licences").cast("long").alias("n_passages"),
        F.array_join(F.transform("licences", lambda m: licenses.licence_name(m["template"])), ",").alias("licenses"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under Jaccard links of 80 percent."""
    return jaccard.near_groups(_documents(spark, sf_dir)).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text (second half replaced by the next document's beginning)."""
    rows = fingerprints.with_next(_documents(spark, sf_dir), "doc_id", "text")
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("_text", n - half), F.left(F.col("_next.text"), half))
    rows = rows.select(
        F.col("_id").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        edited.alias("edited"),
        F.col("_fp").alias("fingerprint"),
        F.col("_next.fp").alias("next_fingerprint"),
    ).withColumn("edited_fingerprint", fingerprints.fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from the rows that are not held out."""
    docs = _documents(spark, sf_dir)
    found = lang_id.predict(docs.select("doc_id", "text"), lang_id.learn(docs))
    return found.select("doc_id", lang_id.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Styles in which the conversations table is written out as transcripts, a marker per role.
_STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("[system] ", "Human: ", "AI: "),
    ("Instructions: ", "Q: ", "A: "),
    ("<<SYS>> ", "### Instruction: ", "### Response: "),
)


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as raw transcript lines: a style per conversation, and one turn in three without its marker."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES))).cast("int")
    role = F.array_position(F.array(*[F.lit(r) for r in chat.ROLES]), F.coalesce("role", F.lit(""))).cast("int")
    marker = F.get(F.get(F.array(*[F.array(*[F.lit(m) for m in s]) for s in _STYLES]), style), role - 1)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(F.coalesce(marker, F.lit(""))), F.coalesce("text", F.lit("")))
    return rows.select("conv_id", "turn", "role", text.alias("text"))


def op7_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered role and canonical rendering of every transcript line; learnt from two thirds of the conversations."""
    return roles_of(_transcripts(spark, sf_dir))


def roles_of(rows: DataFrame) -> DataFrame:
    """Role and rendering of every line of the transcripts; a row without an id is a conversation of its own, its id stays null."""
    lines = chat.lines_of(rows, "conv_id", "turn", "text", keep=["role"])
    model = chat.fit(lines.filter(F.crc32(F.col("conv").cast("binary")) % 3 != 1))
    found = chat.recover(lines.drop("role"), model)
    return found.select(F.col("conv").try_cast("long").alias("conv_id"), "turn", F.col("at").cast("long").alias("line"), "role", "begins", "rendered")


def op8_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack(_documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token-id files written of them."""
    path = scratch_path(spark, "llm-token-files")
    token_files.write(_documents(spark, sf_dir), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and survivor of every document under equality after A-Z folding."""
    return exact_dedup.exact_groups(_documents(spark, sf_dir)).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes they decode to, as digests."""
    found = byte_bpe.decode(byte_bpe.encode(_documents(spark, sf_dir)))
    return found.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every document, with corpus-wide counts of linked ids."""
    return token_links.align(_documents(spark, sf_dir))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return turn_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_mix_sources,
        op3_license_scan,
        op4_jaccard_join,
        op5_fingerprints,
        op6_language_id,
        op7_chat_roles,
        op8_pack_windows,
        op9_token_files,
        op10_exact_dedup,
        op11_byte_bpe,
        op12_token_links,
        op13_turn_trie,
    )
}
