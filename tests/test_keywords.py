"""Search-phrase segmentation (X1/X2) and the lateral split."""

from pyspark.sql import functions as F

from tributary.functions.keywords import keyword_tokens


def test_keyword_fixture(spark):
    df = spark.createDataFrame([(1, "red widget"), (2, ""), (3, None), (4, "实时数仓")],
                               "id int, t string")
    got = {r.id: r.w for r in df.select("id", keyword_tokens("t").alias("w")).collect()}
    assert got[1] == ["red", "widget"]
    assert got[2] == [] and got[3] == []
    assert got[4] == ["实时", "时数", "数仓"]
    lateral = df.select("id", F.explode(keyword_tokens("t")).alias("word"))
    assert sorted({r.id for r in lateral.collect()}) == [1, 4]        # no words -> no row


def test_split_words_sql_surface(spark):
    from tributary.functions.keywords import register_split_words
    register_split_words(spark)
    spark.createDataFrame([("Red Widget 2",)], "t string").createOrReplaceTempView("kw_t")
    rows = spark.sql("SELECT word FROM kw_t, LATERAL split_words(t)").collect()
    assert sorted(r.word for r in rows) == ["2", "red", "widget"]


def test_sql_and_dataframe_tokenizers_agree(spark):
    from tributary.functions.keywords import register_split_words
    register_split_words(spark)
    texts = ["red widget", "", None, "实时数仓", "Mixed 大数据 abc1 x", "单"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    df.createOrReplaceTempView("kw_agree")
    sql_words = sorted((r.id, r.word) for r in
                       spark.sql("SELECT id, word FROM kw_agree, LATERAL split_words(t)").collect())
    df_words = sorted((r.id, r.word) for r in
                      df.select("id", F.explode(keyword_tokens("t")).alias("word")).collect())
    assert sql_words == df_words
    assert (5, "单") in df_words and (4, "大数") in df_words and (4, "数据") in df_words


def test_dictionary_words_all_found_and_the_rest_whole(spark):
    from tributary.functions.keywords import dictionary_words
    d = spark.createDataFrame([("中国",), ("中国人",), ("国人",), ("人民",), ("中国",), ("",), (None,), ("AB",)], "word string")
    phrases = [(1, "中国人民银行 Red-7"), (2, "银行"), (3, None), (4, ""), (5, "人民x人民"), (6, "中"), (7, "国中国人们")]
    t = spark.createDataFrame([(i, x, "extra") for i, x in phrases], "id long, full_word string, word string")
    got = {}
    for r in dictionary_words(t, d, ["id"]).collect():
        got.setdefault(r.id, []).append(r.word)
    assert {k: sorted(v) for k, v in got.items()} == {
        1: sorted(["中国", "中国人", "国人", "人民", "银行", "red", "7"]), 2: ["银行"], 5: sorted(["人民", "人民", "x"]), 6: ["中"],
        7: sorted(["国", "中国", "中国人", "国人", "们"])}
    assert sorted(r.word for r in dictionary_words(t.where("id = 1"), d.limit(0), ["id"]).collect()) == sorted(["中国人民银行", "red", "7"])
