import random

import corpus_pipeline
from tessera.llm import resemblance


def jaccard(a, b):
    sets = [{tuple(x.lower().split()[i : i + 5]) for i in range(max(1, len(x.split()) - 4))} for x in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def planted(rng):
    """Texts of which some are copies with words changed, in chains too; many share a passage."""
    word = lambda: f"w{rng.randrange(5000)}"
    passage = " ".join(word() for _ in range(30))
    texts = []
    for k in range(60):
        own = [word() for _ in range(rng.randrange(3, 200))]
        texts.append(" ".join([passage, *own] if k % 3 == 0 else own))
        for _ in range(k % 4):
            words = texts[-1].split()
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
    return [*texts, "", "  \n", texts[0], texts[-1].upper()]


def first_of_each(texts):
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if parent[i] != parent[j] and (texts[i].split() == texts[j].split() or jaccard(texts[i], texts[j]) >= 0.8):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    return sorted(set(parent))


def test_stage_finds_planted_near_copies(spark):
    texts = planted(random.Random(5))
    want = first_of_each(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1).sortWithinPartitions("doc_id")
    got = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == want
    assert 40 < len(want) < len(texts) - 20


def test_any_order_and_parts_find_the_same(spark):
    texts = planted(random.Random(6))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1).sortWithinPartitions("doc_id")
    for sample, entries in ((1, 50), (10, 1 << 20)):
        assert sorted(r.doc_id for r in resemblance.one_of_each(docs, sample, entries).collect()) == first_of_each(texts)


def test_fingerprints_find_alike_texts_first(spark, monkeypatch):
    """Sets that SimHash puts together are alike, and the prefix index doesn't link them again; nothing is lost."""
    texts = planted(random.Random(7))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1).sortWithinPartitions("doc_id")
    found, whole, near = [], [], resemblance.near

    def kept(firsts, folder, distance):
        found.append(near(firsts, folder, distance))
        return found[-1]

    monkeypatch.setattr(resemblance, "near", kept)
    monkeypatch.setattr(resemblance, "links", lambda *args, links=resemblance.links: whole.append(links(*args)) or whole[-1])
    assert sorted(r.doc_id for r in resemblance.one_of_each(docs).collect()) == first_of_each(texts)
    groups = {r.a: r.b for r in found[0].collect() if r.a != r.b}
    assert groups
    more = [(r.a, r.b) for r in whole[0].collect()]
    assert len(more) > len(groups)  # pairs that differ in more bits
    assert sum(groups.get(a, a) == groups.get(b, b) for a, b in more) == len(groups) + len({*groups.values()})
