"""What Python workers keep between batches: they live on for all stages of a pipeline."""

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tabflow.llm import bpe, toxicity
from tabflow.llm.common import chunks

ROOT = Path(__file__).parents[2]
HELD = """
import re
from tabflow.llm.common import release
def mb():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
held = [bytes(3000) for _ in range(60_000)]
full = mb()
few = held[::100]
del held
release()
print(full - mb())
"""


def test_freed_texts_go_back_to_the_system():
    found = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(ROOT)})
    assert float(found.stdout) > 80, found.stderr  # of some 170 MB, between texts that stay


def test_a_column_comes_in_slices():
    texts = pa.array([*"abcdefg", None])
    assert [x.to_pylist() for x in chunks(texts, 3)] == [["a", "b", "c"], ["d", "e", "f"], ["g", None]]


def test_verdicts_of_many_slices_are_those_of_each_text(spark):
    model = toxicity.Segments({b"vile": 3.0, b"rott*": 2.0}, -0.2, 1.0, -1.0)
    texts = [None if i % 97 == 0 else "" if i % 89 == 0 else f"a {'vile ' * (i % 3)}b{i} rotten é{i}" for i in range(1300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").coalesce(1)
    judged = toxicity.toxicity(model, rows)
    found = {r.i: r.t for r in rows.select("i", judged("text").alias("t")).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        score, evidence, n, passages = toxicity.judge(model, (text or "").encode(), model.heads())
        assert (found[i].score, found[i].evidence, found[i].n_tokens) == (score, evidence, n)
        assert [tuple(p) for p in found[i].passages] == passages


def test_encoder_takes_half_a_mebibyte_at_once():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [None, "", *(f"Word{i} and the {i * 7919} " * 40 for i in range(1500))]
    rows = pa.record_batch({"key_0": pa.array(range(len(texts))), "text": pa.array(texts)})
    found = list(bpe._encoder(SimpleNamespace(value=Path(path).read_text(encoding="utf-8")), bpe.LEAF_CHARS)([rows]))
    sizes = [sum(len(texts[k] or "") for k in part["key_0"].to_pylist()) for part in found]
    assert max(sizes) <= 512 << 10 and len(sizes) > 2
    whole = Tokenizer.from_file(str(path)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids for part in found for ids in part["ids"].to_pylist()] == [e.ids for e in whole]
