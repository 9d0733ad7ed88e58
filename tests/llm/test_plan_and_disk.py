"""What queries leave on disk, and what of the model stands in a plan."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay import session
from assay.llm import licences, packing, substring


def test_stage_frees_what_its_write_shuffled(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("h")).repartition(4, "h")
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(x.getPath()) for x in files.localDirs()]

    def shuffled():
        return {x for folder in folders for x in folder.rglob("shuffle_*.data")}

    before = shuffled()
    staged = session.stage(rows, "freed")
    for _ in range(50):  # they go in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert staged.count() == 1000
    assert spark.conf.get(session.FREE_SHUFFLES) == "false"


def test_passages_are_compared_before_texts_are_dealt_to_be_cut(spark):
    """The write of the texts that are left shuffles nothing of what the comparison shuffled."""
    passage = " ".join(f"w{k}" for k in range(70))
    rows = [(k, f"own{k} {passage} end{k}", 0) for k in range(4)]
    left = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"))
    assert "MapInArrow" not in left._jdf.queryExecution().toString()
    assert {r.doc_id: r.text for r in left.collect()} == {0: rows[0][1]} | {k: f"own{k} end{k}" for k in (1, 2, 3)}


def test_weights_are_rows_and_not_text_of_the_plan(spark):
    names = tuple([licences.NONE, licences.UNKNOWN, "mit"])
    weights = {f"gram{k}": [0.123456789 * k] * 3 for k in range(3000)}
    model = licences.Model(names, (0.0,) * 3, weights, {"gram1": ["mit"]}, 0.5)
    rows = spark.createDataFrame([(1, ["gram1", "gram2"])], "row long, grams array<string>")
    found = licences.classified(rows, model)
    assert "gram2999" not in found._jdf.queryExecution().toString()
    assert [r.row for r in found.collect()] == [1]


@pytest.mark.parametrize("text", ["word###", "l'eau&&& a.b... été,!!", "x²## ½¾$$ ab'## 'tis ª@º", "don't!! it's's### a<b>", json.dumps(["á́##"])])
def test_signs_behind_letters_are_encoded_apart(text):
    encoder = packing.Encoder(packing.default_tokenizer())
    expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text])[0].tolist() == expected


def test_words_with_signs_share_the_ids_of_their_letters():
    encoder = packing.Encoder(packing.default_tokenizer())
    encoder.encode(["lettres### lettres&&&"])
    assert b"lettres" in encoder.cache and b"###" in encoder.cache
