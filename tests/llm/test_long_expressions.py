"""Licence expressions of any length are read whole."""

from barwright.llm import licenses


def test_expression_of_more_than_2000_bytes(spark):
    names = [f"lib{k}-license" for k in range(300)]
    text = "/* SPDX-License-Identifier: (" + " AND ".join(names) + ") OR MIT */ SPDX-License-Identifier: ISC\nnot this"
    rows = [(1, text), (2, "SPDX-License-Identifier: " + " OR ".join([*names, "Zlib"]))]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert out[1]["labels"].split(",") == sorted(["isc", "mit", *names])
    assert out[1]["expressions"][0].endswith(") or mit") and out[1]["expressions"][1] == "isc"
    assert set(out[2]["labels"].split(",")) == {"zlib", *names}
