"""Documents in pieces of bounded size are the whole documents."""

import json

from tessera.sources import annotations as ann


def test_pieces_are_the_whole_document(spark):
    sizes = ", ".join(f"CAST({v} AS DOUBLE) AS {c}" for c, v in (("xmin", "id"), ("ymin", "id % 9"), ("xmax", "id + 2"), ("ymax", "id % 9 + 3")))
    boxes = spark.range(500).selectExpr("CASE WHEN id % 3 > 0 THEN concat('p', id % 3) END AS product", "concat('t', id * 7 % 40) AS tile_path", "id AS object_id", "1 AS category_id", "0.5 AS score", *sizes.split(", "))
    want = {r["product"]: (json.loads(r.document), r.n_images, r.n_annotations) for r in ann.build_documents(boxes, ["product"]).collect()}
    pieces = ann.document_pieces(boxes, ["product"], size=16).orderBy("section", "piece").collect()
    assert max(r.n for r in pieces) == 16 and len(pieces) > 30
    for product, (document, images, notes) in want.items():
        own = [(r.n, json.loads(r.document)) for r in pieces if r["product"] == product]
        for name, n in (("images", images), ("annotations", notes)):
            assert [x for _, d in own for x in d.get(name, [])] == document[name]
            assert sum(k for k, d in own if name in d) == n
