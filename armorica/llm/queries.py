"""The corpus operators as queries over the test tables, with equivalent SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica.llm import chat, decontaminate, langid, middle, mixing, phrases, pii, simhash, spelling, tokens, toxicity, vptree, warc
from armorica.queries.registry import Query, Run, table

QUERIES: dict[str, Query] = {}

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
PII_KEY = "a key for tests; in production it comes from a secret store"
SHINGLE_WORDS, MAX_DISTANCE = 3, 2
TOXIC_FROM = 0.7
NEIGHBOURS = 20
# Of the letter runs, those that lose a letter; what is a word; how much commoner a form is.
MISSPELT, WORD_CHARS, WORD_COUNT, FORM_RATIO = 31, 7, 2, 10
# Exact search.
FACTOR = 1.0


def query(sql: str | None = None):
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted on the documents that are not held out."""
    return langid.fit(docs.filter(~langid.held_out(F.col("doc_id"), 4, 2)).select("text", "lang"))


@query()
def op1_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = tokens.write_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), end_id=END_ID)
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op2_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, out_col="text")


@query()
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, folder, "benchmark")).filter(F.size("items") > 0)
    return found.select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    held_out = langid.held_out(F.col("doc_id"), 4, 2)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = langid.fit_and_identify(docs, ~held_out)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("identified.language").alias("lang_pred"),
        "identified.score",
        "identified.cross_entropy",
        "identified.rejected",
    )


@query(r"""
with w as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), starts as (
    select r, i, list_slice(words, i, i + 34) as seq from w, unnest(range(1, len(words) - 33)) as t(i)
), repeated as (
    select r, i from (select r, i, count(*) over (partition by seq) as n from starts) where n > 1
), covered as (
    select distinct r, j from repeated, unnest(range(i, i + 35)) as t(j)
), gone as (
    select r, list(j) as places, count(*) as n from covered group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
    sha256(array_to_string(case when n is null then words else
        [words[x] for x in range(1, len(words) + 1) if not list_contains(places, x)] end, ' ')) as kept_sha256
from w left join gone using (r)
""")
def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    stripped = phrases.remove_repeats(table(spark, folder, "documents"), digest=True)
    return stripped.withColumnRenamed("kept", "kept_sha256")


@query()
def op6_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=SHINGLE_WORDS, max_distance=MAX_DISTANCE)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    is_held_out = langid.held_out(F.col("doc_id"), 3, 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels.filter(~is_held_out)))
    predicted = F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0)
    return scored.select("doc_id", is_held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query(r"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), b as (
    select *, case when regexp_matches(text, '###|</turn>') or regexp_matches(text, '\\.', 's')
        then regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') else text end as body,
        replace(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '<', '%3C'), chr(10), '%0A') as code from t
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(length(code) + length(body) + 15)::bigint as formatted_chars,
    true as intact
from b group by conv_id
""")
def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    odd = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    written = chat.format_conversations(turns.unionByName(odd))
    read = written.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_mask"))
    )
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")

    def digest(column: Column) -> Column:
        return F.sha2(column.cast("binary"), 256)

    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        digest(whole).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "intact",
    )


@query("""
with v as (
    select row_number() over () as r, vec_id, embedding::double[] as e from embeddings
    where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
    select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
    from v q join v c on q.r <> c.r and len(q.e) = len(c.e) where q.vec_id % 20 = 0
), ranked as (
    select *, row_number() over (partition by r order by score desc, vec_id)::integer as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
""")
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    found = vptree.nearest(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0, NEIGHBOURS, FACTOR)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@query(r"""
with l as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
        sha256('7:' || coalesce(doc_id::varchar, '')) as hex from documents
), h as (
    select *, len(lines) as n, ('0x' || hex[1:8])::ubigint as h1, ('0x' || hex[9:16])::ubigint as h2,
        ('0x' || hex[25:32])::ubigint as h4 from l
), c as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
        case when text = '' or regexp_matches(text, '<[PSM]>') then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from h
), p as (
    select *, array_to_string(lines[1:low], '') as prefix, array_to_string(lines[low + 1:high], '') as middle,
        array_to_string(lines[high + 1:], '') as suffix from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
    case when form <> 'plain' then length(middle) end::bigint as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256 from p
""")
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = middle.fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    restored = middle.restore(F.col("fim.output"), F.col("fim.form"))
    return cut.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


def misspelt_words(docs: DataFrame) -> DataFrame:
    """Rows (word, n): letter runs of the documents, some of which lose a letter, as often as they occur."""
    # Deleting shortens: shorter runs make no words.
    runs = spelling.letter_runs(docs, min_chars=WORD_CHARS)
    hashed = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.withColumn("h", hashed).select(F.when(F.col("h") % MISSPELT == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= WORD_CHARS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= WORD_COUNT)


@query(r"""
with recursive steps as (
    select list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) as of
), runs as (
    select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
), counted as (
    select doc_id, run, count(*) as n from runs where length(run) >= 7 group by all
), octets as (
    select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
        lambda c: case when ord(c) < 128 then [ord(c)] else [195, ord(c) - 64] end)) as codes from counted
), hashed as (
    select run, n, xor(list_reduce(codes, lambda c, x: xor(c // 256, of[xor(c % 256, x) + 1]), 4294967295), 4294967295) as h from octets, steps
), words as (
    select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, sum(n)::bigint as n
    from hashed group by 1 having length(word) >= 7 and sum(n) >= 2
), places as (
    select word, n, unnest(range(1, length(word) + 1)) as i from words
), cut as (
    select distinct word, n, word[1:i - 1] || word[i + 1:] as rest from places
), pairs as (
    select a.word, b.word as near, b.n as near_n from places a join places b
        on a.i = b.i and a.word[1:a.i - 1] || '*' || a.word[a.i + 1:] = b.word[1:b.i - 1] || '*' || b.word[b.i + 1:] and a.word <> b.word
    union all select c.word, w.word, w.n from cut c join words w on c.rest = w.word
    union all select w.word, c.word, c.n from cut c join words w on c.rest = w.word
), best as (
    select word, count(*)::bigint as n_near, max(near_n) as top, arg_min(near, row(-near_n, near)) as near from pairs group by word
), known as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 10 * w.n then near end as form,
        case when top >= 10 * w.n then top end as form_n from words w left join best b using (word)
), followed as (
    select word, word as root from known where form is null
    union all select k.word, f.root from known k join followed f on k.form = f.word
)
select word, form, root, n, n_near, form_n from known join followed using (word)
""")
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(misspelt_words(table(spark, folder, "documents")), ratio=FORM_RATIO)


@query("""
with p as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p
)
select page_id, payload_bytes, payload_digest, case when page_id <> first then 'revisit' else 'response' end as record_type,
    case when page_id <> first then first end as refers_to from f
""")
def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = warc.write_warc(table(spark, folder, "pages"))
    found = warc.read_pages(spark, path)
    return found.select(
        F.col("id").cast("bigint").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )
