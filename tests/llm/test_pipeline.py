"""Each stage against a plain version, and the whole pipeline over awkward and empty tables."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from vitrine.llm.common import stored

from .helpers import awkward, docs, plain
from .test_decontaminate import brute as leaks
from .test_mixing import water
from .test_quality import corpus as quality_corpus

ITEMS = [(1, "The moon for a while"), (2, "never seen")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = quality_corpus()
    path = str(tmp_path_factory.mktemp("sf"))
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    seen, df = [], spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in C.STAGES:
        df = stored(stage(spark, df, folder), "test-stage")
        assert name == C.STAGES[-1][0] or df.columns == columns
        seen.append(df.collect())
    rated, distinct, clean, mixed, coded = seen
    assert not any("***" in (r.text or "") for r in rated)
    # The good texts differ in a few words only, so one of them stays.
    assert sum((r.text or "").startswith("plain words") for r in distinct) == 1
    assert len({r.text for r in distinct}) == len(distinct)
    hits = {(r[0], r[1]) for r in leaks([(r.doc_id, r.text) for r in distinct], ITEMS) if r[2]}
    assert len(clean) == len(distinct) - len(hits)
    sizes, took = {}, {}
    for rows, out in ((clean, sizes), (mixed, took)):
        for r in rows:
            out[r.source] = out.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert {s: n for s, n in took.items() if n} == {s: int(t + 1e-6) for s, t in water(sizes).items() if int(t + 1e-6)}
    library, start, want = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER)), 0, []
    for r in sorted(mixed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode())):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, coded), key=lambda r: r[1]) == want


def test_run_is_its_stages(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES:
        df = stored(stage(spark, df, folder), "test-stage")
    assert plain(C.run(spark, folder)) == plain(df)


def test_empty_tables(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_awkward_rows_pass_every_stage(spark, folder):
    for _, stage in C.STAGES:
        assert stage(spark, docs(spark, awkward()), folder).count() > 0
