"""The stages one by one against brute force, and the whole against the stages."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from test_models import corpus as labelled_corpus
from test_near import expected as near_components
from texts import words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(11)
    rows, labels = labelled_corpus(400)
    for group in range(15):
        base = words(900 + group, 60)
        for _ in range(draw.randrange(1, 5)):
            w = list(base)
            w[draw.randrange(60)] = "edit"
            rows.append((len(rows), " ".join(w)))
        rows.append((len(rows), rows[-1][1].replace(" ", "\n")))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "z " * 9000)]
    path = str(tmp_path_factory.mktemp("sf"))
    full = [(i, t, "en", draw.choice("aab"), None, i) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int, position long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, tables[-1], folder)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
        if i < 4:
            seen.append({r["doc_id"]: r["text"] for r in tables[-1].collect()})

    toxic = [i for i, t in seen[0].items() if any(b in (t or "").lower() for b in ("nasty", "vile", "rotten"))]
    assert len(set(toxic) & set(seen[1])) <= 0.03 * len(toxic)
    assert len(set(seen[0]) - set(toxic) - set(seen[1])) <= 0.01 * len(seen[0])

    groups = defaultdict(list)
    for i, t in seen[1].items():
        groups["".join((t or "").split())].append((-len(t or ""), i))
    assert set(seen[2]) == {min(g)[1] for g in groups.values()}
    assert set(seen[3]) == {i for i, _, c in near_components(sorted(seen[2].items()), 5, 80) if i == c}

    passes = Counter(r["doc_id"] for r in tables[4].collect())
    assert max(passes.values()) <= 2 and set(passes) <= {i for i, t in seen[3].items() if (t or "").split()}
    size = {i: len((t or "").split()) for i, t in seen[3].items()}
    total = sum(n * size[i] for i, n in passes.items())
    assert abs(total - 1.5 * sum(size.values())) <= 3 * max(size.values()) / 2

    packed = Counter()
    for r in tables[5].collect():
        packed[r["doc_id"]] += r["size"]
    assert packed == {i: n * size[i] for i, n in passes.items()}
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, tables[5].collect()))


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 0")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.schema(out.schema).parquet(str(tmp_path / str(i)))
        assert docs.count() == 0


def repeated(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    full = [(i, t, "en", s, None, n) for n, (i, t, s) in enumerate(rows)]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int, position long").write.parquet(path)
    return spark.read.parquet(path)


def test_mix_takes_each_row_by_its_own_passes(spark, tmp_path):
    draw = random.Random(21)
    rows = [(None if n % 3 else 7 if n % 2 else n, " ".join(words(n, draw.randrange(0, 30))), draw.choice("abc")) for n in range(150)]
    docs = repeated(spark, tmp_path, rows)
    passes = Counter(r["position"] for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    size = [len(t.split()) for _, t, _ in rows]
    for source in "abc":
        of = [n for n in range(150) if rows[n][2] == source]
        target = {r["target"] for r in corpus_pipeline.mixing.mix(docs).filter(f"source_size = {sum(size[n] for n in of)}").collect()}
        assert len(target) == 1 and abs(sum(passes[n] * size[n] for n in of) - target.pop()) <= 15
    assert all(size[n] for n in passes)


def test_one_row_of_each_group_of_copies_stays(spark, tmp_path):
    a, b, c = (" ".join(words(n, 40)) for n in (1, 2, 3))
    near = " ".join(["edit", *a.split()[1:]])  # one of 36 shingles
    rows = [(1, a), (1, a), (1, a.replace(" ", "\t")), (None, a), (2, a), (2, b), (None, c), (None, c), (None, ""), (5, " ")]
    docs = repeated(spark, tmp_path, [(i, t, "s") for i, t in rows])
    exact = corpus_pipeline.drop_copies(spark, docs, "").select("doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, "".join(r["text"].split())) for r in exact) == sorted(
        (i, "".join(t.split())) for i, t in [(1, a), (2, b), (0, c), (5, "")]
    )
    (tmp_path / "near").mkdir()
    rows = [(1, a), (1, a), (None, near), (2, near), (2, b), (None, c), (None, c + " end"), (None, None), (3, "")]
    docs = repeated(spark, tmp_path / "near", [(i, t, "s") for i, t in rows])
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert len(kept) == 5 and sum(r["doc_id"] is None for r in kept) == 2
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(1, a), (2, b), (None, None), (3, "")}
