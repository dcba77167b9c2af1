"""Small tables and the awkward rows every operator must take."""

import itertools
from contextlib import contextmanager

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SAMPLE = "/root/testdata/sf0.001"

AWKWARD_TEXTS = [
    None,
    "",
    " \t\n",
    "a",
    "Aé ü  naïve  <|endoftext|> it's   x\n y  ÷ × 12 a",
    "the same words again and the same words again",
    "the same words again and the same words again",
    "long " * 20_000,
]


def docs_of(spark, texts, extra=""):
    """One document for each text, ids from 0, with columns that clash with the
    names operators use inside."""
    rows = [
        (i, t, "en", f"src{i % 2}", None if t is None else len(t), i, "x", b"y")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows, DOCS + ", _group bigint, start string, fingerprint binary"
    )


def awkward(spark):
    docs = docs_of(spark, AWKWARD_TEXTS)
    row = docs.limit(1).selectExpr(
        "CAST(NULL AS bigint) doc_id", "'no id' text", *docs.columns[2:]
    )
    twice = docs.filter("doc_id = 5")
    return docs.unionByName(row).unionByName(twice)


def empty(spark):
    return docs_of(spark, ["x"]).limit(0)


@contextmanager
def changing_parallelism(spark, *modules):
    """Between any two staged steps the number of cores seems to change, so that
    each job cuts its files anew, as when executors are lost or join."""
    names = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes"]
    before = {name: spark.conf.get(name, None) for name in names}
    originals = {module: module.staged for module in modules}
    turns = itertools.cycle([(1, "1g"), (7, "20k"), (3, "90k")])

    def turning(df, label):
        result = originals[modules[0]](df, label)
        for name, value in zip(names, next(turns)):
            spark.conf.set(name, value)
        return result

    try:
        for module in modules:
            module.staged = turning
        for name, value in zip(names, next(turns)):
            spark.conf.set(name, value)
        yield
    finally:
        for module, original in originals.items():
            module.staged = original
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
