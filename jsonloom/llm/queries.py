"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.llm import exact_dedup as exact
from jsonloom.llm import chat, decontamination, lexical, line_dedup, lm_scoring, mixing, near_dedup, pieces, pii, sharding, toxicity, vector_codes
from jsonloom.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    r"""
    with crc as (
        select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, b: case when c & 1 = 1
            then xor(3988292384, c >> 1) else c >> 1 end, n)) t),
    sized as (
        select doc_id, coalesce(strlen(text), 0) + 8 as size,
            list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: cast('0x' || h as bigint)) as b
        from documents),
    hashed as (
        select doc_id, size, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) as text_crc32
        from sized, crc),
    summed as (
        select *, sum(size) over (order by doc_id rows between unbounded preceding and current row) - size as start,
            sum(size) over () as total
        from hashed),
    cut as (select *, least(23, start * 24 // total) as k from summed)
    select doc_id, size, text_crc32, 'bytes' as law, cast(k as integer) as shard,
        row_number() over (partition by k order by doc_id) - 1 as slot, cast(null as integer) as grown_shard
    from cut
    """
)
def op3_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 contiguous shards of nearly equal bytes."""
    return sharding.shard_by_bytes(table(spark, folder, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    r"""
    with n as (
        select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
        from documents),
    g as (
        select *, first_value(doc_id) over (partition by norm order by chars desc, doc_id) as keep_id,
            count(*) over (partition by norm) as group_size
        from n)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from g
    """
)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one of its group of equal texts that stays."""
    return exact.exact_dedup(table(spark, folder, "documents")).drop("row")


@query()
def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes, and its source's target."""
    return mixing.mix_report(cut_lineage(mixing.slim(table(spark, folder, "documents"), seed=9)))


@query()
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return near_dedup.near_dedup(table(spark, folder, "documents")).drop("row")


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity."""
    return toxicity.toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    r"""
    with cut as (
        select page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) as host,
            list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(coalesce(html, ''),
                '<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(10), 'gs'), '<[^<>]*>', chr(10), 'g'), '[\r\n]+'),
                lambda x: regexp_replace(x, '^[ \t]+|[ \t]+$', '', 'g')), lambda x: x <> '') as lines
        from pages),
    totals as (select host, count(*) as pages from cut group by host having count(*) >= 4),
    held as (select host, line, count(*) as n from (select host, unnest(list_distinct(lines)) as line from cut) group by host, line),
    common as (select host, list(line) as common from held join totals using (host) where n > 0.1 * pages and n >= 3 group by host)
    select page_id, cut.host, len(lines) as n_lines, len(lines) - len(list_filter(lines, lambda x: not list_contains(coalesce(common, []), x))) as n_dropped,
        array_to_string(list_filter(lines, lambda x: not list_contains(coalesce(common, []), x)), chr(10)) as text
    from cut left join common on cut.host = common.host
    """
)
def op2_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's text without its site's boilerplate lines."""
    return line_dedup.line_dedup(table(spark, folder, "pages"))


@query()
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, exact or edited."""
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base spans, and all spans."""
    rows = pii.find_pii(table(spark, folder, "documents")).withColumn("base", F.array_sort("base"))
    count = lambda i: F.size(F.filter("base", lambda s: s["order"] == i)).cast("bigint")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"),
    )


@query()
def op1_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log10 probability under the context-mixing model and under unigrams."""
    return lm_scoring.lm_scores(table(spark, folder, "documents")).drop("row")


@query(
    r"""
    with given as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
    marked as (
        select *, 22 + length(regexp_replace(role, '([\\<"])', '\\\1', 'g')) + length(regexp_replace(text, '([\\<"])', '\\\1', 'g')) as chars from given)
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        cast(sum(chars) as bigint) as formatted_chars
    from marked group by conv_id
    """
)
def op4_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that holds control strings, read back from the prefix tree."""
    odd = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return chat.chat_report(given.unionAll(more))


def _part_sql(books: str, parts: str) -> str:
    """SQL of the nearest entry of each part, lower entries first in ties."""
    return f"""
        select row, part, arg_min(entry, (far, entry)) as entry, min(far) as far from (
            select p.row, p.part, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as far
            from {parts} p join {books} b on p.part = b.part) group by row, part"""


def _mean_sql(near: str, books: str) -> str:
    """SQL of the entries' floored means; unused entries stay."""
    mean = ", ".join(f"cast(floor(sum(p.x[{j}]) / count(*)) as bigint)" for j in range(1, 5))
    return f"""
        select b.part, b.entry, coalesce(m.x, b.x) as x from {books} b left join (
            select n.part, n.entry, [{mean}] as x from {near} n join parts p using (row, part) group by n.part, n.entry) m using (part, entry)"""


@query(
    f"""
    with kept as (
        select row_number() over (order by vec_id) as row, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    parts as (
        select row, part, list_slice(v, 4 * part + 1, 4 * part + 4) as x from kept, (select unnest(range(16)) as part)),
    b0 as (select part, row - 1 as entry, x from parts where row <= 64),
    n0 as ({_part_sql("b0", "parts")}), b1 as ({_mean_sql("n0", "b0")}),
    n1 as ({_part_sql("b1", "parts")}), b2 as ({_mean_sql("n1", "b1")}),
    n2 as ({_part_sql("b2", "parts")}),
    coded as (select row, string_agg(lower(printf('%02x', entry)), '' order by part) as code, cast(sum(far) as bigint) as error from n2 group by row),
    books as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from b2)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
    from coded join kept using (row), books
    """
)
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every kept vector's code of 16 parts from codebooks of 64 entries after 2 rounds."""
    coded, codes = vector_codes.encode_vectors(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@query(
    r"""
    with given as (
        select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
        from documents),
    docs as (select row, doc_id, w, len(w) as n from given where len(w) > 0),
    totals as (select count(*) as nd, cast(sum(n) as bigint) as nl from docs),
    items as (
        select row_number() over () as i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as w
        from benchmark),
    asked as (select i, unnest(w) as term from items),
    cells as (
        select row, term, count(*) as tf from (select row, unnest(w) as term from docs) where term in (select term from asked) group by row, term),
    weights as (
        select term, cast(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) as bigint) as weight
        from (select term, count(*) as df from cells group by term), totals),
    scored as (
        select i, row, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // nl))))) as bigint) as score
        from asked join weights using (term) join cells using (term) join docs using (row), totals group by i, row),
    ranked as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored join docs using (row) where score > 0)
    select item_id, cast(rank as integer) as rank, doc_id, score from ranked join items using (i) where rank <= 50
    """
)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    index = lexical.build_index(table(spark, folder, "documents"))
    return lexical.search(index, table(spark, folder, "benchmark"), k=50)


@query()
def op13_piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's piece ids and what they decode to, as digests."""
    encoded = pieces.encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
