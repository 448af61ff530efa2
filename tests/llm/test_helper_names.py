"""Input columns may have any name, those an operator uses for itself included."""

import pytest
from pyspark.sql import functions as F

from strata.llm import credentials, decontaminate, langid, mixing, quoting, sharding, simhash, urlfilter

#: Names that operators or their helpers use, or used, for columns of their own.
NAMES = """__hash __tie __stratum __in_n __all_n __at __c_rows __mix_key __mix_size __mix_source __mix_id __plan_size __label_id __quality __size
__copy __mixed_copies __host __path __m __guess __conv __turn __lines __runs __text __leaks __id guess words label_id weight leaks_ judged key id
scan row tie conv hash check own_text passages place_n mixed_size mixed_copies row_id text_hash fp component level root of to near chars""".split()


def wide(df, *taken):
    return df.select("*", *[F.lit(f"mine {n}").alias(n) for n in NAMES if n not in (*df.columns, *taken)])


def docs(spark):
    rows = [(i, f"some words of the text number {i} and its {i % 3} friends", ("a", "b", None)[i % 3], ("en", "de")[i % 2]) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def labels(spark):
    return spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")


def chats(spark):
    rows = [(1, 0, "some words that somebody said"), (1, 1, "> some words that somebody said\nyes"), (2, 0, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, text string")


def bench(spark):
    return spark.createDataFrame([(1, "text number 7 and its 1 friends")], "item_id long, text string")


def urls(spark):
    return spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")


OPERATORS = {
    "keep_identified": lambda s, f: langid.keep_identified(f(docs(s))),
    "identify": lambda s, f: langid.identify(f(docs(s))),
    "keep_one": lambda s, f: simhash.keep_one(f(docs(s))),
    "find_leaks": lambda s, f: decontaminate.find_leaks(f(docs(s)), bench(s)),
    "drop_leaks": lambda s, f: decontaminate.drop_leaks(f(docs(s)), bench(s)),
    "mix": lambda s, f: mixing.mix(f(docs(s))),
    "mix_documents": lambda s, f: mixing.mix_documents(f(docs(s)), labels(s)),
    "apply_mix": lambda s, f: mixing.apply_mix(f(docs(s)), labels(s)),
    "interleave_shards": lambda s, f: sharding.interleave_shards(f(docs(s)), 4),
    "find_secrets": lambda s, f: credentials.find_secrets(f(docs(s))),
    "link_quotes": lambda s, f: quoting.link_quotes(f(chats(s), "own_text", "passages"), originals_col="originals"),
    "parse_quotes": lambda s, f: quoting.parse_quotes(f(chats(s), "own_text", "passages")),
    "judge": lambda s, f: urlfilter.judge(f(urls(s)), urlfilter.build_digest_array(s.createDataFrame(urlfilter.RULES, "host string, path string, verdict string"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_carried_columns_keep_names_and_values(spark, name):
    """As without them, and every extra column comes back as it went in."""
    plain = OPERATORS[name](spark, lambda df, *taken: df)
    got = OPERATORS[name](spark, wide)
    extra = [c for c in got.columns if c in NAMES and c not in plain.columns]
    assert len(extra) >= len(NAMES) - 3
    rows = got.collect()
    assert rows and all(r[c] == f"mine {c}" for r in rows for c in extra)
    assert sorted(str([r[c] for c in plain.columns]) for r in rows) == sorted(str(list(r)) for r in plain.collect())
