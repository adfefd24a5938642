"""Secrets of any length are replaced whole."""

from barwright.llm import surrogates


def test_long_secrets(spark):
    part = "Zq7w" * 75  # 300 characters
    texts = [f'token="{part}" end', f"secret: {part}x", f"secret: {part}y", f"key sk-{part} end"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r["doc_id"]: r for r in surrogates.replace_entities(frame, "key").collect()}
    assert all(out[k]["n_replaced"] == 1 and out[k]["kinds"] == ["SECRET"] and "Zq7wZq7w" not in out[k]["text"] for k in out)
    assert [len(out[k]["text"]) for k in range(4)] == [len(t) for t in texts]
    # What differs at the end only is two secrets.
    assert out[1]["text"][:60] != out[2]["text"][:60]
    for k in (0, 3):
        assert out[k]["text"].endswith(" end")
