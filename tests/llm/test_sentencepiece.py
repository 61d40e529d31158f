import duckdb
import public_tokenizers
import pytest
import sentencepiece as library
from cases import awkward, clashing, empty

from sensoria.llm import sentencepiece


@pytest.fixture(scope="module")
def reference():
    return library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_ids_are_the_librarys(reference):
    model = sentencepiece.compiled()
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    texts += [r[0] for r in duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()]
    texts += ["", " ", "   a", "a   b\n\n c\t", "漢字 𝕏 é", "aaaa" * 999, "1234567890 <s> </s> <unk> <0x41>", "\x00\x7f"]
    for text in texts:
        ids = model.encode(text)
        assert ids == reference.encode(text), text[:60]
        assert model.decode(ids) == text


def test_cheapest_path_is_the_least_of_all_paths():
    costs = {"a": 2.5, "b": 1.5, "ab": 3.2, "ba": 3.9, "aba": 4.4, "c": 0.5, "bc": 2.2}
    model = sentencepiece.Transducer({p: i for i, p in enumerate(costs)}, costs, [], 99, False, list(costs))

    def paths(text):
        if not text:
            return [(0.0, ())]
        out = []
        for n in (1, 2, 3):
            if text[:n] in costs and len(text[:n]) == n:
                out += [(costs[text[:n]] + c, (model.ids[text[:n]], *p)) for c, p in paths(text[n:])]
        return out

    for text in ("a", "ab", "aba", "abab", "bcab", "ababcba", "cabcbab"):
        least = min(paths(text))[0]
        assert sum(costs[model.pieces[i]] for i in model.shortest(text)) == pytest.approx(least)


def test_awkward_rows(spark):
    found = sentencepiece.round_trips(clashing(awkward(spark)))
    rows = {r.doc_id: (r.n_ids, r.restored) for r in found.collect()}
    assert rows[3] == (0, None) and rows[4] == (0, True)
    assert all(ok for doc, (_, ok) in rows.items() if doc != 3)
    both = sentencepiece.decoded(sentencepiece.encoded(awkward(spark)))
    assert all(r.decoded == r.text for r in both.collect())
    assert sentencepiece.round_trips(empty(spark)).count() == 0
