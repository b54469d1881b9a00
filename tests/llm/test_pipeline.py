"""The corpus pipeline on a small folder of tables, stage by stage."""

import random

import corpus_pipeline
from loomsite.llm.common import materialize


def test_stages(spark, tmp_path):
    rnd = random.Random(12)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(500)]

    def text(n=90):
        return " ".join(rnd.choice(plain) for _ in range(n))

    rows = [(i, text(), "en", "s", 1, i) for i in range(240)]
    toxic = set(range(0, 240, 4))
    rows = [(i, t + " Zork" + "".join(rnd.choice("aeioulnst") for _ in range(4)) if i in toxic else t, *rest) for i, t, *rest in rows]
    item = text(25)
    near = rows[1][1].split()
    near[40] = "changed"
    rows += [(300, rows[1][1] + "\nand a second line that is not in the other one", "en", "s", 1, 0), (301, " ".join(near), "en", "s", 1, 0), (305, rows[2][1] + "\n" + text(40), "en", "s", 1, 0), (302, text(30) + " " + item + " " + text(30), "en", "s", 1, 0), (303, "", "en", "s", 0, 0), (304, None, None, None, None, 0)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, item long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), "test")
        kept[name] = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns or name == "bpe_encode"
        if name == "line_dedup":
            left = {r.doc_id: r for r in docs.collect()}
            assert left[305].text == rows[-4][1].split("\n")[1] and left[305].n_chars == len(left[305].text)
            assert left[304].text is None and left[303].text == ""
    everything = {r[0] for r in rows}
    assert kept["toxicity"] == everything - toxic
    assert kept["line_dedup"] == kept["toxicity"] - {300}
    assert kept["near_copies"] == kept["line_dedup"] - {301}
    assert kept["decontaminate"] == kept["near_copies"] - {302}
    assert kept["bpe_encode"] == kept["decontaminate"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == kept["bpe_encode"]
