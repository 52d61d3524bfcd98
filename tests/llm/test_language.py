import zlib

from pyspark.sql import functions as F

from lexitrend.llm import catalog
from lexitrend.llm import op12_language_id as language
from tests.llm import edge

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = catalog.QUERIES["op12_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got["doc_id"], got["held_out"]))
    own = got[got["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() >= 0.97
    sure = own[own["accepted"]]
    assert len(sure) > 0.9 * len(own) and (sure["lang_pred"] == sure["lang"]).mean() >= 0.985
    assert got["score"].between(0, 1).all()


def test_held_out_languages_are_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    turned = docs.withColumn("lang", F.when(language.fold("doc_id", 5) == 0, F.lit("zz")).otherwise(F.col("lang")))
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs).collect()}
    b = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(turned).collect()}
    assert a == b


def test_smallest_size_by_plain_compression(spark):
    """The chosen language is the one whose compressor, called here by itself, gives least."""
    import zstandard as z

    raw = {"aa": b"banana bandana cabana " * 40, "bb": b"quick brown foxes jumping " * 40}
    model = language.Model(("aa", "bb"), (raw["aa"], raw["bb"]))
    text = "a quick banana and brown foxes jumping"
    size = []
    for g in model.languages:
        d = z.ZstdCompressionDict(raw[g], dict_type=z.DICT_TYPE_RAWCONTENT)
        p = z.ZstdCompressionParameters.from_level(5, source_size=8192, dict_size=len(raw[g]), min_match=3,
                                                   write_content_size=False, write_checksum=False, write_dict_id=False)
        size.append(len(z.ZstdCompressor(dict_data=d, compression_params=p).compress(language.LEAD + text.encode())))
    assert model.sizes(text) == size and size[1] < size[0]
    assert model.decide(text)[0] == "bb"
    assert len(model.sizes("x" * 100_000)) == 2                 # whole texts, block after block


def test_ties_and_narrow_margins():
    same = language.Model(("en", "de"), (b"abc def ghi " * 50,) * 2)
    pred, score, accepted = same.decide("abc def")
    assert (pred, score, accepted) == ("en", 0.5, False)        # more documents first; not accepted
    assert language.Model((), ()).decide("abc") == ("und", 0.0, False)
    assert same.decide("") == ("und", 0.0, False) and same.decide(None) == ("und", 0.0, False)


def test_reject(spark):
    same = language.Model(("en", "de"), (b"abc def ghi " * 50,) * 2)
    docs = spark.createDataFrame([(1, "abc def"), (2, "...")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, same, reject=True).collect()}
    assert got == {1: "und", 2: "und"}


def test_edges(spark):
    docs = edge.documents(spark).withColumn("lang", F.when(F.col("doc_id") == 8, None).otherwise(F.lit("en")))
    got = language.predict(docs).collect()
    assert len(got) == len(edge.ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by[3] == [("und", 0.0)] and by[4] == [("und", 0.0)] and by[9] == [("und", 0.0)]
    assert {x for k, v in by.items() if k not in (3, 4, 9) for x in v} == {("en", 1.0)}
    assert language.predict(edge.empty(spark, "doc_id long, text string, lang string")).collect() == []
    none = language.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
