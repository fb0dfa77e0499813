"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, decontaminate, langid, packing, pii, quality, repeats, secrets, simhash, token_counts, toxicity, whitening, winnowing
from .common import split_remainder, written


# A deployment sets its own secret here; results are reproducible with this one.
PII_KEY = "surrogates-1"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return secrets.digest_secrets(secrets.find_secrets(docs, keep=["doc_id"]))


def op2_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (split_remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op3_simhash(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    prints = written(simhash.fingerprints(docs, keep=["doc_id"]), "fingerprints")
    return simhash.near_duplicates(prints).select("doc_id", "fingerprint", "component_id")


def op4_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (split_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_decontaminate(spark, sf_dir):
    found = decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").alias("n_items"),
                        F.transform("hits", lambda h: h["item_id"]).alias("item_ids"),
                        F.transform("hits", lambda h: h["distance"]).alias("distances"))


def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


def op8_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY)


def op9_winnowing(spark, sf_dir):
    return winnowing.compare_with_edited(_table(spark, sf_dir, "documents"))


def op10_language(spark, sf_dir):
    found = langid.identify(_table(spark, sf_dir, "documents"))
    # spans as lang:words:letters, in order
    parts = F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["words"], s["letters"]))
    return found.withColumn("spans", F.array_join(parts, ","))


def op11_whitening(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    error = whitening.identity_error(rows, model)
    explained = F.array(*(F.lit(float(v / model.total)) for v in model.variances)).cast("array<double>")
    return (whitening.whiten(rows, model, keep=["vec_id"])
            .select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def op12_repeats(spark, sf_dir):
    found = repeats.find_repeats(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return repeats.digest(found).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_codes(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    books = codes.train_codebooks(rows)
    coded = codes.with_label_error(codes.encode(rows, books, keep=["vec_id", "label"]))
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", digits.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_counts": op7_token_counts,
    "op8_pii": op8_pii,
    "op9_winnowing": op9_winnowing,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_repeats": op12_repeats,
    "op13_codes": op13_codes,
}

# Queries that SQL can express, as DuckDB statements.
_REPEATS = r"""
with split as (select doc_id, regexp_extract_all(ifnull(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
spots as (select doc_id, words, unnest(range(1, len(words) - 11)) as spot from split),
passages as (select doc_id, spot, array_to_string(words[spot:spot + 12], ' ') as passage from spots),
later as (select doc_id, spot from passages qualify min(doc_id) over (partition by passage) < doc_id),
gone as (select distinct doc_id, spot + step as spot from later, range(0, 13) steps(step)),
each as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as spot from split),
told as (select e.doc_id, e.word, e.spot, g.spot is not null as lost from each e left join gone g using (doc_id, spot))
select s.doc_id, len(s.words) as n_words, count(*) filter (t.lost) as n_removed,
       sha256(ifnull(string_agg(t.word, ' ' order by t.spot) filter (not t.lost), '')) as kept_sha256
from split s left join told t using (doc_id) group by all"""


def _codes_sql() -> str:
    """The rounds written out one after the other."""
    steps = ["""whole as (select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             "parts as (select vec_id, label, part, v[part * 8 + 1:part * 8 + 8] as v from whole, range(0, 8) parts(part))",
             "book0 as (select part, row_number() over (partition by part order by vec_id) - 1 as entry, v as c from parts qualify entry < 16)"]
    apart = "list_sum(list_transform(list_zip(p.v, b.c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::bigint"
    for r in range(codes.ROUNDS + 1):
        steps.append(f"""near{r} as (select vec_id, part, any_value(p.label) as label, any_value(p.v) as v, min({{'apart': {apart}, 'entry': entry}}) as best
    from parts p join book{r} b using (part) group by vec_id, part)""")
        if r < codes.ROUNDS:
            means = ", ".join(f"((sum(v[{i}]) - ((sum(v[{i}]) % count(*)) + count(*)) % count(*)) // count(*))::bigint" for i in range(1, 9))
            steps.append(f"""book{r + 1} as (select b.part, b.entry, ifnull(m.c, b.c) as c from book{r} b
    left join (select part, best.entry as entry, [{means}] as c from near{r} group by all) m using (part, entry))""")
    last = codes.ROUNDS
    steps.append(f"digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as d from book{last})")
    steps.append(f"""coded as (select vec_id, any_value(label) as label, string_agg(printf('%02x', best.entry), '' order by part) as code,
    sum(best.apart)::bigint as error from near{last} group by vec_id)""")
    return "with " + ",\n".join(steps) + """
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, d as codebooks_sha256 from coded, digest"""


ORACLE_SQL: dict[str, str] = {"op12_repeats": _REPEATS, "op13_codes": _codes_sql()}
