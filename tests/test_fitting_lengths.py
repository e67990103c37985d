from tierweave.operators import similarity


def test_texts_of_no_fitting_length_are_left_out_first(spark, monkeypatch):
    item = "a benchmark passage about prefix trees and their many uses"
    rows = [("copy", item), ("near", item + "!!"), ("longest", item + " of today"), ("over", item + " that nobody counts")]
    rows += [(f"long{i}", f"{item} and document {i} goes on " * 20) for i in range(20)]
    probes = spark.createDataFrame(rows, "slug string, text string")
    held = spark.createDataFrame([("item", item), ("none", "z" * 5000)], "slug string, text string")
    kept = []

    def seen(df, real=similarity.cut_lineage):
        out = real(df)
        if "text" in out.columns:
            kept.append({r.text for r in out.select("text").collect()})
        return out

    monkeypatch.setattr(similarity, "cut_lineage", seen)
    got = {r.slug: r.ratio for r in similarity.near_duplicate_texts(probes, held).collect()}
    want = {s: r for s, t in rows if (r := similarity.ratio_at_least(t, item, 0.9)) is not None}
    assert got == want and set(got) == {"copy", "near", "longest"}
    assert kept and all(len(t) < 100 for texts in kept for t in texts)
