import corpus_pipeline as P
from tessera.llm.language_id import held_out_mod  # noqa: F401
from tests.llm.test_decontaminate import sh
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"
S = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90001, "12 !!", "en", "s", 5), (90002, None, "en", None, None), (90003, "", None, "src1", 0)], S)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id < 3"))
    one = P.identify_language(spark, docs, SF)
    kept = collect(one)
    assert kept == [r for r in collect(docs) if r[0] < 90000]
    one = one.cache()
    two = collect(P.drop_near_duplicates(spark, one, SF))
    uniq = sorted({r[:2] for r in kept})
    comp = brute_components([r[0] for r in uniq], [brute_fp(r[1]) for r in uniq], 2)
    assert [r[0] for r in sorted(two)] == [r[0] for r, c in zip(uniq, comp) if r[0] == c]
    mid = spark.createDataFrame(two, S)
    three = collect(P.decontaminate_benchmark(spark, mid, SF))
    items = [sh(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert three == [r for r in two if not any(i and len(i & sh(r[1])) >= 0.8 * len(i) - 1e-9 for i in items)]
    assert len(three) < len(two) < len(kept)
    four = P.mix_sources(spark, spark.createDataFrame(three, S), SF)
    assert four.columns == docs.columns and {r.doc_id for r in four.collect()} <= {r[0] for r in three}


def test_empty_table_passes_all_stages(spark):
    docs = spark.createDataFrame([], S)
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        assert out.count() == 0
        assert k == len(P.STAGES) - 1 or out.columns == docs.columns


def test_nulls_and_clashing_columns(spark):
    rows = [(1, "und der die das ist", "de", "src1", 3, "a"), (None, "und der die das ist", None, None, None, "b"), (2, None, "de", "src1", 1, None),
            (3, "the of and to in", "en", "src2", 9, "c"), (3, "the of and to in", "en", "src2", 9, "c")]
    docs = spark.createDataFrame(rows, S + ", fp string").withColumn("component_id", P.F.lit(7)).withColumn("item_id", P.F.lit(1)).withColumn("_n", P.F.lit(1))
    for name, stage in P.STAGES[:-1]:
        nxt = stage(spark, docs, SF)
        assert sorted(nxt.columns) == sorted(docs.columns), name
        docs = spark.createDataFrame(nxt.collect(), nxt.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert set(ids) <= {1, 3, None}
    assert P.STAGES[-1][1](spark, docs, SF).count() >= 1


NAMES = ["score", "lang_pred", "_times", "_own", "_fp", "full", "cut", "_mix_id", "_key", "_n", "mix_epoch", "mix_tokens", "fp", "component_id",
         "item_id", "Text", "a.b", "further_3", "_own0", "domain"]


def test_columns_of_any_name_come_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.unionByName(docs.where("doc_id in (5, 7)")).select("*", *[P.F.concat(P.F.lit(f"{c}:"), P.F.col("doc_id").cast("string")).alias(c) for c in NAMES])
    for name, stage in P.STAGES[:-1]:
        nxt = stage(spark, docs, SF)
        assert nxt.columns == docs.columns, name
        rows = nxt.collect()
        assert rows
        for r in rows:
            assert list(r)[-len(NAMES):] == [f"{c}:{r.doc_id}" for c in NAMES], name
        docs = spark.createDataFrame(rows, nxt.schema)
    assert P.STAGES[-1][1](spark, docs, SF).count() >= 1


def test_texts_are_fingerprinted_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = P.drop_near_duplicates(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    # the second fingerprint runs on rows that came through the join with repeated ids, never on the scan
    for part in plan.split("ArrowEvalPython")[1:]:
        assert "Join" in part.split("Scan parquet")[0] or "InMemoryTableScan" in part.split("Scan parquet")[0], part[:800]


def test_run(spark):
    r = P.run(spark, SF)
    assert r.count() > 0 and r.select("slot").distinct().count() == r.count()
