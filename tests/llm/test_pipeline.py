"""The pipeline, stage by stage against plain versions, and as a whole."""
from collections import Counter

import corpus_pipeline
from tidewater.llm.common import materialize

from .conftest import SF
from .test_dedup import plain_components, plain_repeats
from .test_scans import plain_quality


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    rows = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == cols
        out = docs.collect()
        if name == "quality_rules":
            want = {x[0]: t for x, t in plain_quality([(r.doc_id, r.text, r.source) for r in rows]) if t is not None}
            assert any(len(want[r.doc_id]) < len(r.text) for r in rows if r.doc_id in want)  # lines do go
        elif name == "near_duplicates":
            least = {i: c for i, _, c, _ in plain_components([(r.doc_id, r.text) for r in rows], 5, 80)}
            want = {r.doc_id: r.text for r in rows if least[r.doc_id] == r.doc_id}
        elif name == "repeated_passages":
            flags = plain_repeats([(r.doc_id, r.text) for r in rows], 200, "first")
            want = {r.doc_id: bytes(x for x, f in zip(r.text.encode(), flags[r.doc_id, r.text]) if not f)
                    .decode("utf-8", "ignore") for r in rows}
        else:
            want = {r.doc_id: r.text for r in out}
            assert set(want) <= {r.doc_id for r in rows} and len(out) > .5 * len(rows)
        assert Counter((r.doc_id, r.text) for r in out) == Counter(want.items())
        assert all(r.n_chars == len(r.text) for r in out)
        rows = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in rows}
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def plain_stage(name, rows):
    """The (id, text) rows that a stage keeps of (id, text, host); None for the draw of the mixture."""
    if name == "quality_rules":
        return Counter((x[0], t) for x, t in plain_quality(rows) if t is not None)
    if name == "repeated_passages":
        flags = plain_repeats([r[:2] for r in rows], 200, "first")
        cut = lambda i, t: bytes(x for x, f in zip(t.encode(), flags[i, t]) if not f).decode("utf-8", "ignore")
        return Counter((i, t if t is None else cut(i, t)) for i, t, _ in rows)
    return None


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        cols = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
            docs = materialize(stage(spark, docs, SF), name)
            assert docs.columns == cols
            got = Counter((r.doc_id, r.text) for r in docs.collect())
            want = plain_stage(name, rows)
            if name == "near_duplicates":
                # one row of every component; the ids of the smallest stay
                least = {i: c for i, _, c, _ in plain_components([r[:2] for r in rows], 5, 80) if i is not None}
                assert len(got) == sum(got.values()) and set(got) <= {r[:2] for r in rows}
                assert {least[i] for i, _ in got if i is not None} == set(least.values())
            elif name == "source_mixture":
                assert set(got) <= {r[:2] for r in rows}
            else:
                assert got == want
        kept = {r.doc_id for r in docs.collect()}
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert {r.doc_id for r in packed.collect()} == kept
