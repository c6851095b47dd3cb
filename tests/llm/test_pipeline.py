"""Every stage against a plain version on its own input, and the whole run."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from stockweave.session import materialise, scratch_path, shared_folder
from tests.llm.test_decontaminate import plain as plain_contamination
from tests.llm.test_near_dup import plain as plain_components
from tests.llm.test_pii import plain as plain_pii
from tests.llm.test_quality import plain as plain_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) rows by stage name."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SMALL), name)
        out[name] = (before.collect(), docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality(spark, stages):
    before, after = stages["quality_rules"]
    failed = set()
    for r in before:
        n_words, _, _, _, repeated = plain_quality(r.text)
        if n_words < 20 or 100 * repeated > 30 * n_words:
            failed.add(r.doc_id)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = set(ids(after))
    good = {d for d, r in labels.items() if r.quality == 1 and not r.toxic} - failed
    bad = {d for d, r in labels.items() if r.quality == 0}
    assert not kept & failed and good <= kept and len(bad & kept) <= 0.2 * len(bad)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    components = plain_components({r.doc_id: r.text for r in before})
    assert ids(after) == sorted({c for _, c in components.values()})


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = plain_contamination([(r.doc_id, r.text) for r in before], items)
    assert ids(after) == sorted(r[0] for r in found if not r[-1])


def test_personal_data(stages):
    before, after = stages["personal_data"]
    texts = {r.doc_id: r for r in after}
    assert ids(before) == ids(after)
    for r in before:
        clean = texts[r.doc_id]
        assert clean.n_chars == len(clean.text) and not plain_pii(clean.text)
        spans = plain_pii(r.text)
        for kind in ("email", "ip", "card", "phone"):
            assert clean.text.count(f"<{kind.upper()}>") >= sum(s.startswith(kind) for s in spans) - len(spans) // 2
        if not spans and "<" not in clean.text:
            assert clean == r


def test_packing(stages):
    before, after = stages["sequence_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {(r.doc_id, r.piece): r for r in after}
    for r in before:
        own = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(own), 4096)):
            part = np.array(own[start : start + 4096], "<u4")
            row = pieces.pop((r.doc_id, piece))
            assert (row.start, row.length, row.ids_crc32) == (start, len(part), zlib.crc32(part.tobytes()))
    assert not pieces


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, stages["sequence_packing"][1]))


def test_written_run_leaves_nothing_behind(spark, stages):
    def stored():
        return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}

    before, path = stored(), scratch_path(spark, "sequences")
    corpus_pipeline.write(spark, SMALL, path)
    assert stored() - before == {path.rsplit("/", 1)[1]}
    rows = spark.read.parquet(path).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, stages["sequence_packing"][1]))
