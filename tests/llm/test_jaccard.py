"""N-gram Jaccard join and connected components, against brute force."""

import random
import re

import pytest

from tallyloom.llm import components, jaccard_join


def sets(rows):
    out = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    return out


def brute(rows):
    """(doc_id, size of the set, smallest id of the component) of each row."""
    found = sets(rows)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(found):
        for j in range(i):
            y = found[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for k, (doc, _) in enumerate(rows):
        ids.setdefault(top(k), []).append(doc)
    least = {t: min((d for d in v if d is not None), default=None) for t, v in ids.items()}
    return sorted(((doc, len(found[k]), least[top(k)]) for k, (doc, _) in enumerate(rows)), key=repr)


def result(docs):
    return sorted((tuple(r) for r in jaccard_join.groups(docs).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def family(seed, texts, edits, words=60):
    """A text, many edited copies of it, some chains of edits, and copies of copies."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(texts):
        one = list(r.choice(out).split() if out and r.random() < 0.3 else base)
        for _ in range(r.randrange(edits + 1)):
            one[r.randrange(len(one))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(one))
    return out


@pytest.mark.parametrize(("rare", "element"), [(1, 1), (1, 512), (1000, 512)])
def test_equals_brute_force(docs_of, monkeypatch, rare, element):
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    monkeypatch.setattr(jaccard_join, "RARE_ELEMENT", element)
    texts = family(1, 60, 4) + family(2, 40, 2, 200) + family(3, 10, 6, 30)
    shared = " ".join(f"p{k}" for k in range(40))
    texts += [f"{shared} {' '.join(f'q{n}x{k}' for k in range(12))}" for n in range(30)]
    texts += ["", None, "a b", "A B", "a b c d e", "a b c d e", "a b c d e f", " \t\n"]
    rows = [(k * 7 % 1000, t) for k, t in enumerate(texts)] + [(None, texts[0]), (None, "alone in the world with no id"), (0, texts[3])]
    assert result(docs_of(rows)) == brute(rows)


def test_all_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(documents) == brute(rows)


def test_no_rows(empty):
    assert result(empty) == []
    assert jaccard_join.keep_one(empty).count() == 0


def test_one_of_each_group_stays(odd, docs_of):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect() if r.doc_id in (5, 6)) == sorted(
        {(5, "one two three four five six seven."), (6, "one"), (6, "another text of this id, which is longer.")}
    )
    texts = family(5, 30, 1)
    assert [r.doc_id for r in jaccard_join.keep_one(docs_of([(k + 3, t) for k, t in enumerate(texts)])).collect()] == [3]


def test_rows_are_known_by_id_and_text(docs_of):
    one, other, near = "a b c d e f g h i j k l m n o p q r s t", "quite another text, which has nothing to do with it", "a b c d e f g h i j k l m n o p q r s u"
    rows = [(1, one), (2, near), (2, other), (None, one), (None, "a third text of nobody, with words of its own"), (None, other), (3, one), (3, one), (4, ""), (4, None), (4, "")]
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(docs_of(rows)).collect()]
    assert sorted(kept, key=repr) == sorted(
        [(1, one), (2, other), (None, "a third text of nobody, with words of its own"), (4, ""), (4, ""), (4, None)], key=repr
    )


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), (None, 3)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: top(x) for x in list(root)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
