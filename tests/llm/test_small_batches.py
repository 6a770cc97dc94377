"""Small batches, and what a packing worker holds."""

import os
import sys

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lathe.llm import langid, packing, toxicity  # noqa: E402
from lathe.llm.batches import ROWS, slices, with_text  # noqa: E402
from lathe.llm.queries import tokenizer_path  # noqa: E402
from lathe.session import build_session  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def test_a_kept_text_goes_to_python_once(spark):
    df = spark.createDataFrame([(1, "der alte Fluss"), (2, None), (3, "the old river")], "doc_id long, text string")
    ready, at = with_text(df, ["doc_id", "text"], "text")
    assert (ready.columns, at) == (["doc_id", "text"], 1)
    other, at = with_text(df.withColumnRenamed("text", "t.x"), ["doc_id"], "`t.x`")
    assert (other.columns, at) == (["doc_id", "__text"], 1)
    model = langid.train(df.withColumn("lang", df["doc_id"].cast("string")))
    got = [(r["doc_id"], r["text"], r["lang_pred"]) for r in langid.identify(df, model).orderBy("doc_id").collect()]
    assert got == [(1, "der alte Fluss", "1"), (2, None, "und"), (3, "the old river", "3")]
    for told in (langid.identify(df, model), toxicity.score(df, None)):
        assert "__text" not in told._jdf.queryExecution().executedPlan().toString()


def test_batches_are_small_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000))], ["x"])
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert max(p.num_rows for p in parts) == ROWS
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(1000))


def test_plain_texts_need_one_tokenizer():
    w = packing.Words(tokenizer_path("word_bpe_49k.json"))
    plain, other = "A small mill, 3 rivers.", "Река 中文 ran"
    first = w.encode([plain])[0]
    assert "tokenizer" not in vars(w)
    assert first.tolist() == w.tokenizer.encode(plain, add_special_tokens=False).ids
    assert w.encode([other])[0].tolist() == w.tokenizer.encode(other, add_special_tokens=False).ids
