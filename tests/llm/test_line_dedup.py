import random

from cases import awkward, clashing, empty
from pyspark.sql import functions as F

from sensoria.llm import line_dedup


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice("xyz"))
        elif kind == 1 and len(chars) > 1:
            chars.pop(at)
        else:
            chars[at] = rng.choice("xyz")
    return "".join(chars)


def test_banded_distance(spark):
    rng = random.Random(3)
    pairs = []
    for size in [1, 2, 5, 17, 40, 150] * 30:
        a = "".join(rng.choice("abcé漢") for _ in range(size))
        pairs.append((a, edited(rng, a, rng.randint(0, 4))))
    pairs += [("", "a"), ("ab", ""), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for threshold in (1, 2, 3):
        close = df.where(F.abs(F.length("a") - F.length("b")) <= threshold)
        for r in close.withColumn("d", line_dedup.banded_distance(F.col("a"), F.col("b"), threshold)).collect():
            truth = distance(r.a, r.b)
            assert (r.d if r.d <= threshold else None) == (truth if truth <= threshold else None), (r.a, r.b)


def test_classes_equal_brute_force(spark):
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcdefgh ij") for _ in range(n)).strip().ljust(n, "k") for n in (16, 18, 25, 60, 61)]
    lines = [edited(rng, rng.choice(bases), rng.randint(0, 4)) for _ in range(250)]
    lines += rng.sample(lines, 40) + ["short", "", "  "]
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 10 : i * 10 + 10])) for i in range(30)]
    found = line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    first = {}
    for doc, text in docs:
        for number, line in enumerate(text.split("\n")):
            line = line.strip(" \t\r")
            if len(line) >= 16:
                first.setdefault(line, (doc, number))
    texts = list(first)
    links = {a: {b for b in texts if a != b and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2} for a in texts}
    label = dict(first)
    for _ in texts:
        label = {a: min([label[a], *[label[b] for b in links[a]]]) for a in texts}
    by_place = {(doc, n): line.strip(" \t\r") for doc, text in docs for n, line in enumerate(text.split("\n"))}
    assert len(found) == sum(len(x) >= 16 for x in by_place.values())
    for r in found:
        line = by_place[(r.doc_id, r.line)]
        assert (r.class_doc_id, r.class_line) == label[line]
        assert r.n_links == len(links[line])
        assert r.kept == (label[line] == (r.doc_id, r.line))


def test_lines_of_common_keys_equal_brute_force(spark, monkeypatch):
    """Lines that share a third meet by finer keys, and not all with all."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ij") for _ in range(45)).strip().ljust(45, "k")
    changed = {base[:15] + "".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(70)}
    lines = list(changed) + [edited(rng, base, rng.randint(1, 3)) for _ in range(20)]
    lines += [edited(rng, rng.choice(lines), rng.randint(1, 2)).strip().ljust(20, "k") for _ in range(30)]
    lines = list(dict.fromkeys(lines))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    met, crowded_pairs = [], line_dedup._crowded_pairs

    def counted(texts, *args):
        found = line_dedup.cut_lineage(crowded_pairs(texts, *args))
        met.append((texts.where("crowded").count(), found.count()))
        return found

    monkeypatch.setattr(line_dedup, "_crowded_pairs", counted)
    found = {r.doc_id: r.n_links for r in line_dedup.line_classes(docs).collect()}
    links = dict.fromkeys(range(len(lines)), 0)
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                links[i], links[j] = links[i] + 1, links[j] + 1
    assert found == links
    assert met[0][0] > 70 and met[0][1] < met[0][0] ** 2 / 8


def test_all_lines_meet_by_pieces(spark, monkeypatch):
    """With every key common no pair comes from the index; a line has a few dozen keys at most."""
    rng = random.Random(11)
    written, piece_rows = [], line_dedup.piece_rows

    def counted(lines, s):
        found = line_dedup.cut_lineage(piece_rows(lines, s))
        written.append(found.count() / lines.count())
        return found

    monkeypatch.setattr(line_dedup, "piece_rows", counted)
    for threshold in (1, 2, 3):
        bases = ["".join(rng.choice("abcdefgh ij") for _ in range(n)).strip().ljust(n, "k") for n in (19, 21, 40, 83)]
        lines = [edited(rng, rng.choice(bases), rng.randint(0, 4)).strip().ljust(19, "k") for _ in range(160)]
        lines = list(dict.fromkeys(lines))
        docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
        settings = line_dedup.Settings(threshold=threshold, counted=1, common=1)
        found = {r.doc_id: r.n_links for r in line_dedup.line_classes(docs, settings).collect()}
        assert found == {
            i: sum(a != b and abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold for b in lines)
            for i, a in enumerate(lines)
        }
    assert len(written) == 3 and written[1] <= 54


def test_dropping_keeps_first_lines(spark):
    a, b = "a line that is long enough to count", "another line, also long enough"
    rows = [(1, f"{a}\nx\n{b}", 5), (2, f"{a[:-1]}\ny", 5), (3, b, 5), (4, None, None), (None, a, 5), (5, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert found == {1: (f"{a}\nx\n{b}", 5), 2: ("y", 1), 4: (None, None), None: (a, 5), 5: ("", 0)}


def test_short_lines_take_part(spark):
    rows = [(1, "Read more\nab\nelevenchars\n"), (2, "Read more\nac\nelevencharz"), (3, "own words\nRead mor\nab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.line): (r.class_doc_id, r.class_line) for r in line_dedup.line_classes(docs, line_dedup.WHOLE).collect()}
    same = {(2, 0): (1, 0), (2, 2): (1, 2), (3, 2): (1, 1)}
    places = [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2)]
    assert found == {place: same.get(place, place) for place in places}
    left = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert left == {1: rows[0][1], 2: "ac", 3: "own words\nRead mor"}


def test_query_has_every_line(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    lines = sum(bool(line.strip(" \t\r")) for r in docs for line in (r.text or "").split("\n"))
    assert line_dedup.op2_line_dedup(spark, folder).count() == lines


def test_rows_of_one_id_keep_their_own_lines(spark):
    a, b, c = "a line that is long enough", "quite another one, also long", "words found in no other row"
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{c}"), (2, f"{c[::-1]}\n{b}"), (2, f"{c}!!!\n{c[:5] * 6}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert found == sorted([rows[0], (2, c), (2, c[::-1]), rows[3]])


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    assert line_dedup.line_classes(docs).count() == 5
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns
    assert line_dedup.line_classes(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = line_dedup.op2_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
