from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from dialtrail.llm import jaccard
from dialtrail.llm.jaccard import Rule
from dialtrail.llm.mixing import mix
from dialtrail.llm.surrogates import DEFAULT_KEY, Surrogates, rewritten
from tests.llm.helpers import DOCS, SAMPLE, awkward, changing_parallelism, docs_of, empty
from tests.llm.test_jaccard import brute as brute_links
from tests.llm.test_packing import check as check_packing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and returned over a whole table."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SAMPLE}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SAMPLE).write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, result)
        docs = result
    return out


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_columns_stay(stages):
    wanted = list(stages["language_id"][0].columns)
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name][1].columns == wanted


def test_language_stage_keeps_what_has_letters(stages):
    docs, kept = stages["language_id"]
    given, left = dict(rows(docs, "doc_id", "text")), dict(rows(kept, "doc_id", "text"))
    assert all(given[i] == t for i, t in left.items())
    gone = [given[i] for i in given.keys() - left.keys()]
    assert all(not any(c.isalpha() for c in t or "") for t in gone)
    assert all(any(c.isalpha() for c in t) for t in left.values())


def kept_by_brute_force(given):
    rule = Rule(5, 80, 100)
    found = brute_links([(i, t) for i, (_, t) in enumerate(given)], rule)
    groups = {}
    for i, _, group in found:
        groups.setdefault(group, []).append(i)
    first = lambda i: (given[i][0] is None, given[i][0] or 0, i)
    return Counter(given[min(g, key=first)] for g in groups.values())


def test_one_of_each_group_stays(stages):
    docs, kept = stages["near_copies"]
    given = rows(docs, "doc_id", "text")
    left = Counter(rows(kept, "doc_id", "text"))
    assert left == kept_by_brute_force(given) and len(left) < len(given)


def test_parallelism_that_changes_changes_nothing(spark, stages):
    docs, kept = stages["near_copies"]
    with changing_parallelism(spark, pipeline, jaccard):
        again = Counter(rows(pipeline.drop_near_copies(spark, docs, SAMPLE), "doc_id"))
    assert again == Counter(rows(kept, "doc_id"))


def test_personal_data_goes(stages):
    docs, kept = stages["personal_data"]
    surrogates = Surrogates(DEFAULT_KEY)
    wanted = {i: rewritten(t, surrogates)[0] for i, t in rows(docs, "doc_id", "text")}
    found = rows(kept, "doc_id", "text", "n_chars")
    assert {i: t for i, t, _ in found} == wanted
    assert all(n == len(t) for _, t, n in found)
    assert wanted != dict(rows(docs, "doc_id", "text"))


def test_mixing_orders_everything(stages):
    docs, mixed = stages["mixing"]
    assert sorted(map(str, docs.collect())) == sorted(map(str, mixed.collect()))
    order = mix(docs, repeat=False).orderBy("mix_slot", "mix_place")
    assert rows(mixed, "doc_id") == rows(order, "doc_id")


def test_packing_holds_every_id(stages):
    docs, packed = stages["packing"]
    check_packing(docs, packed)


def test_run_is_the_stages(spark, stages):
    found = Counter(rows(pipeline.run(spark, SAMPLE), "doc_id", "start", "ids_crc32"))
    assert found == Counter(rows(stages["packing"][1], "doc_id", "start", "ids_crc32"))


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_awkward_and_empty(spark, tmp_path, name, stage):
    """Stages take stored tables, extra columns included."""
    clashing = {c: F.lit(c) for c in ("_row", "lang_pred", "score", "text_size", "stretch", "_of")}
    few_labels = F.when(F.col("doc_id") > 3, F.col("lang"))
    awkward(spark).withColumns({"lang": few_labels, **clashing}).write.parquet(f"{tmp_path}/a")
    docs = spark.read.parquet(f"{tmp_path}/a")
    result = stage(spark, docs, SAMPLE)
    if name == "near_copies":
        given, left = rows(docs, "doc_id", "text"), rows(result, "doc_id", "text")
        # Empty sets are linked with nothing: each of them stays.
        assert Counter(left) == kept_by_brute_force(given)
    else:
        assert result.count() > 0
    if name != "packing":
        assert result.columns == docs.columns
        assert {r._row for r in result.collect()} == {"_row"}
    assert stage(spark, empty(spark), SAMPLE).count() == 0


def test_no_label_to_learn_from(spark):
    """No labels at all, or only in rows that are held out: what has a letter stays."""
    docs = docs_of(spark, ["some words", "1 2", None, "é", ""] * 9)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    for label in (F.lit(None).cast("string"), F.when(held_out, "en")):
        given = docs.withColumn("lang", label)
        kept = pipeline.keep_known_languages(spark, given, "")
        wanted = given.filter(F.col("text").isin("some words", "é"))
        assert kept.columns == given.columns and wanted.count() == 18
        assert sorted(map(str, kept.collect())) == sorted(map(str, wanted.collect()))


def test_repeated_rows_without_ids(spark, tmp_path):
    rows_ = [(None, "one two three four five six", "en", "s", 3)] * 3 + [
        (7, "one two three four five six", "en", "s", 3)
    ] * 2
    spark.createDataFrame(rows_, DOCS).write.parquet(f"{tmp_path}/t")
    kept = pipeline.drop_near_copies(spark, spark.read.parquet(f"{tmp_path}/t"), "").collect()
    assert [r.doc_id for r in kept] == [7]
    alone = spark.createDataFrame(rows_[:3], DOCS)
    assert pipeline.drop_near_copies(spark, alone, "").count() == 1
    assert docs_of(spark, []).count() == 0
