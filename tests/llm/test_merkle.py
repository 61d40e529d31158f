import hashlib

from cases import awkward, clashing, empty

from sensoria.llm import merkle

S = merkle.Settings()


def test_whole_table_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in merkle.op9_fingerprints(spark, folder).collect()}
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert len(found) == len(rows)
    closer = 0
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        r = found[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(text.encode(), S)
        assert r.edited_fingerprint == merkle.fingerprint(changed.encode(), S)
        assert r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(after.encode(), S))
        closer += r.near_edited > r.near_next
    assert closer / len(rows) > 0.98


def test_leaves_rebuild_the_text_and_locate_edits():
    text = "\n".join(f"paragraph {i} " + f"some words {i} here and there " * (i % 9) for i in range(60)).encode()
    assert b"".join(merkle.leaves(text, S)) == text
    changed = text.replace(b"paragraph 30 ", b"paragraph 3O ")
    one, other = merkle.fingerprint(text, S), merkle.fingerprint(changed, S)
    assert one.split("|")[0] != other.split("|")[0]
    mine, theirs = merkle.edits(one, other)
    parts = merkle.leaves(text, S)
    assert 1 <= len(mine) <= 3 and any(b"paragraph 30" in parts[i] for i in mine) and theirs
    assert merkle.likeness(one, other) > 0.95
    assert merkle.likeness(one, one) == 1 and merkle.edits(one, one) == ([], [])


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    found = merkle.edited_fingerprints(docs).collect()
    assert len(found) == 11
    marks = {r.doc_id: r.fingerprint for r in found}
    assert marks[3] == marks[4] and marks[1] == marks[2]
    # order: NULL key, 1, 2, 2, 3 ...; the last is followed by the first
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].near_next == 1.0 and by_id[3].near_next == 1.0
    assert [r.near_next for r in found if r.doc_id == 2].count(1.0) == 1
    assert merkle.fingerprints(docs).count() == 11
    assert merkle.edited_fingerprints(empty(spark)).count() == 0
    single = awkward(spark).where("doc_id = 7")
    assert merkle.edited_fingerprints(single).first().near_next == 1.0
