"""The registered queries on the smallest tables, and the pipeline stage by stage against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from check_oracle import compare, connect
from tests.llm.conftest import SF
from tests.llm.test_curriculum import targets
from tests.llm.test_decontaminate import smith_waterman
from tests.llm.test_minhash import brute_force as near_roots
from vitals.llm import decontaminate, minhash, queries, tokens, toxicity
from vitals.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, written and read again."""
    docs, out = table(spark, SF, "documents"), []
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        folder = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(folder)
        after = spark.read.parquet(folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        out.append((docs.collect(), after.collect(), docs))
        docs = after
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "source_mix", "token_output"]


def test_toxic_documents_go(spark, stages):
    before, after, docs = stages[0]
    score = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).select("doc.doc_id", "score").collect()}
    assert {r.doc_id for r in after} == {i for i, s in score.items() if s < 0.5}
    assert 0 < len(before) - len(after) < 0.3 * len(before)


def test_one_of_each_class_stays(stages):
    before, after, docs = stages[1]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = near_roots([r.text or "" for r in before], minhash.inverse_frequencies(docs), minhash.SIMILARITY)
    assert {r.doc_id for r in after} == {before[i].doc_id for i in set(roots)}


def test_leaks_go(spark, stages):
    before, after, _ = stages[2]
    items = decontaminate.Items([(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    kept = {r.doc_id for r in after}
    for r in before:
        numbers = items.numbers(r.text or "")
        near = [i for i, t in enumerate(items.texts) if np.isin(t, numbers).sum() >= decontaminate.THRESHOLD * len(t)]
        best = max((decontaminate.align(items.texts[i], numbers[None, :])[0][0] / len(items.texts[i]) for i in near), default=0)
        assert (r.doc_id in kept) == (best < decontaminate.THRESHOLD), (r.doc_id, best)
    assert smith_waterman(items.texts[0], items.texts[0]) == len(items.texts[0])


def test_sources_meet_their_targets(stages):
    before, after, _ = stages[3]
    size = {r.doc_id: len((r.text or "").split()) for r in before}
    own, got, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        own[r.source] += size[r.doc_id]
        most[r.source] = max(most[r.source], size[r.doc_id])
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    for r in after:
        got[r.source] += size[r.doc_id]
    for source, target in targets(own).items():
        assert -1 <= got[source] - target <= most[source]  # the last document of a source is whole


def test_tokens_are_those_of_the_texts(stages):
    before, after, _ = stages[4]
    whole = Tokenizer.from_file(tokens.vocabulary_file())
    whole.encode_special_tokens = True
    wanted = Counter()
    for r in before:
        ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        wanted[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == wanted
    after = sorted(after, key=lambda r: r.start)
    assert [r.start for r in after] == np.cumsum([0] + [r.n_tokens for r in after[:-1]]).tolist()


def test_all_ten_are_registered():
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in registry.queries()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_against_sql(spark, name):
    same, note = compare(spark, connect(SF), SF, name)
    assert same, note
