"""What language ID and collocations hold in memory at once."""

import pyarrow as pa
import numpy as np

from pyspark.sql import functions as F

from tabloom.llm import language, phrases, token_ids


def test_windows_are_handed_over_in_small_batches():
    words = [f"w{i}".encode() for i in range(300)]
    stream = np.array([*range(1, 301), 0, *range(1, 301), 0], "<i4").tobytes()
    block = pa.RecordBatch.from_arrays(
        [pa.array(["en"]), pa.array([words], pa.list_(pa.binary())), pa.array([stream], pa.binary())], names=["lang", "words", "stream"]
    )
    places = 1 << 12
    marked = [bytes([255]) * (places // 8)] * 2
    small = list(phrases.counted_windows(block, 0, marked, places, 64))
    whole = list(phrases.counted_windows(block, 0, marked, places))
    assert max(b.num_rows for b in small) <= 64 and len(whole) == 1
    assert [r for b in small for r in b.to_pylist()] == whole[0].to_pylist()
    assert sum(r["n"] for r in whole[0].to_pylist()) == 600


def test_language_shares_equal_scores_and_remembers_unseen_words_only(spark):
    rows = spark.createDataFrame([(1, "alpha beta gamma", "en"), (2, "eins zwei drei", "de")], "doc_id long, text string, lang string")
    model = language.fit(rows)
    scores = list(model.known[0].values())
    assert len({id(s) for s in scores}) == len(set(scores)) < len(scores)
    assert model.predict("alpha unheard")[0] in ("en", "de") and set(model.cache) == {"unheard"}


def test_blocks_of_a_file_are_row_groups_of_bounded_size(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    paths = []
    monkeypatch.setattr(phrases, "BLOCK_FILE", 1 << 10)
    monkeypatch.setattr(phrases, "scratch_path", lambda s, label, path=phrases.scratch_path: paths.append(path(s, label)) or paths[-1])
    rows = [("en", " ".join(f"w{i}x{j}" for j in range(500)).encode()) for i in range(6)]
    blocks = phrases.encoded(spark.createDataFrame(rows, "lang string, text binary").coalesce(1), 200)
    assert blocks.count() == 6
    (file,) = glob.glob(f"{paths[0].removeprefix('file://')}/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups == 6  # one of all, as Parquet sees sizes after 100 rows only


def test_language_id_lets_go_of_encoders_that_its_worker_holds(monkeypatch):
    monkeypatch.setattr(token_ids, "_ENCODERS", {("path", 1): object()})
    assert list(language._words(iter([]))) == [] and token_ids._ENCODERS == {}


def test_kept_texts_are_handed_back_few_at_a_time_in_their_place(spark, monkeypatch):
    monkeypatch.setattr(language, "ROWS_AT_ONCE", 2)
    rows = [(i, None if i == 3 else f"alpha {i}", "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = language.WordModel(["de", "en"], {0: {"alpha": (-2.0, -1.0)}} | {n: {} for n in range(1, 6)}, (0.0, 0.0))
    for keep in (("doc_id", "text"), ("text", "lang"), ("doc_id",)):
        found = language.predict(docs, model, keep=keep)
        plan = found._jdf.queryExecution().analyzed().toString()
        assert "_text" not in plan or "text" not in keep  # before, a kept text went to the workers twice
        assert sorted(map(str, found.select(*keep, "lang_pred").collect())) == sorted(
            str(docs.select(*keep).withColumn("lang_pred", F.lit("und" if r[1] is None else "en")).collect()[r[0]]) for r in rows
        )
