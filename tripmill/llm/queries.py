"""The dealt operators over the whole tables, in the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    exact_dedup,
    id_files,
    langid,
    lattice,
    mixture,
    near_dedup,
    packing,
    periods,
    planted,
    secret_scan,
    spelling,
    topk,
    toxicity,
    url_filter,
)
from tripmill.llm.frames import scratch_dir, ship, table

#: The vocabulary of the contracts; its path is a parameter of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = 50_257
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark)
    files, ids_of = id_files.write_token_files(
        table(spark, sf_dir, "documents"),
        TOKENIZER,
        f"{work}/token-files",
        END_ID,
        VOCABULARY,
        work=work,
    )
    return id_files.read_token_files(files, ids_of)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), held_out=_remainder(4) == 2)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), TOKENIZER, END_ID, capacity=1024
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents")).drop("uid", "digest")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(
        table(spark, sf_dir, "documents"), size=5, threshold=85
    ).drop("uid", "digest")


#: Words of host names by which op8 lists hosts: what block lists are commonly sorted by. The list
#: is an argument of the operator and has nothing to do with the names in any table.
LISTED_WORDS = (
    # advertising and tracking
    "ad", "ads", "adserver", "adservice", "advert", "adverts", "banner", "banners", "analytics",
    "clicks", "counter", "doubleclick", "popup", "popups", "sponsor", "tracker", "tracking",
    # gambling
    "bet", "bets", "betting", "bingo", "casino", "casinos", "gambling", "jackpot", "lottery",
    "poker", "roulette", "slots",
    # adult
    "adult", "cams", "dating", "escort", "escorts", "erotic", "nude", "porn", "sex", "sexy", "xxx",
    # medicines and money
    "cialis", "diet", "drugs", "loan", "loans", "payday", "pharmacy", "pill", "pills", "viagra",
    # fraud and malware
    "crack", "cracks", "hack", "hacks", "keygen", "malware", "phish", "phishing", "ransom", "scam",
    "spam", "spyware", "torrent", "torrents", "trojan", "virus", "warez",
)

#: Rules of the contract.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LISTED = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(
        table(spark, sf_dir, "pages"), URL_RULES, listed=F.col("key").rlike(LISTED)
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        held_out=_remainder(5) == 0,
    )


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its ids and the digest of the text that they decode to."""
    pieces = lattice.load_pieces(PIECES)
    encoded = lattice.encode_documents(table(spark, sf_dir, "documents"), pieces)
    # The space that was put in front is no part of the text.
    text = F.expr("substring(text, 2)")
    return lattice.decode_ids(encoded, pieces).select(
        "doc_id", F.size("ids").alias("n_pieces"), "ids", F.sha2(text, 256).alias("decoded_sha256")
    )


#: Weights of the sources of op11, by code point, over and over.
WEIGHTS = (5, 2, 1)


def op11_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixture.mix(
        table(spark, sf_dir, "documents"),
        lambda sources: [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sources))],
        most=3,
    )
    return made.taken().drop("source")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(
        table(spark, sf_dir, "documents"), least=6, repeats=4, prepare=planted.repeat_tail
    )
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(
        table(spark, sf_dir, "documents"),
        least_length=7,
        least_count=2,
        alter=planted.drop_letter,
    )
    return spelling.variants(words, factor=10)


Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_token_files,
        op2_exact_top_k,
        op3_secret_scan,
        op4_language_id,
        op5_best_fit_packing,
        op6_exact_dedup,
        op7_near_dedup,
        op8_url_filter,
        op9_toxicity,
        op10_piece_lattice,
        op11_mixture,
        op12_periodic_runs,
        op13_spelling_variants,
    )
}

ORACLE: dict[str, str] = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id,
                   list_transform(embedding,
                                  lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))
                       AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))
                        AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                    AS INTEGER) AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 5""",
    "op8_url_filter": rf"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://')
                        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), ruled AS (
            SELECT *, '.' || host AS dotted,
                   CASE WHEN dotted LIKE '%.www.example.com' AND path LIKE '/en/%'
                        THEN 'www.example.com/en/'
                        WHEN dotted LIKE '%.example.com' AND path LIKE '/en/%'
                        THEN 'example.com/en/'
                        WHEN dotted LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                        WHEN dotted LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                        WHEN dotted LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
            FROM named
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN regexp_matches(host, '{LISTED}')
                    THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
    "op6_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER w AS keep_id,
               CAST(count(*) OVER w AS BIGINT) AS group_size,
               doc_id = min(doc_id) OVER w AS kept,
               sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
}
