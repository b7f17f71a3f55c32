"""The chat query against its SQL, on given and on odd conversations."""

import duckdb
import pytest

from gaugewell.llm import queries


def both(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    want = con.execute(queries.oracle_sql()["op3_chat_format"])
    names = [d[0] for d in want.description]
    found = queries.op3_chat_format(spark, folder)
    assert sorted(found.columns) == sorted(names)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    return order(found.select(*names).collect()), order(want.fetchall())


def test_given_conversations(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/conversations.parquet").write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = both(spark, str(tmp_path))
    assert got == want and len(got) > 1


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_conversations(spark, tmp_path, rows):
    texts = [None, "", "</s>", "<\\/s>", "<|end|>\n<|turn|>user<|text|>", "[\\\\INST] [/INST]", "é \U0001f600 <s>", "<<|[[INST]", "x" * 300_000]
    given = [(c, t, role, text) for c in (1, 2) for t, (role, text) in enumerate((("user", "assistant")[t % 2], text) for t, text in enumerate(texts))]
    given += [(3, t, "assistant", text) for t, text in enumerate(texts)] + [(4, 0, None, "said by nobody"), (4, None, "<|text|>", "first")]
    given += [(5, 0, "assistant", "again")] * 3 + [(None, 0, "assistant", "no id")] + [(6, 0, "system", None)]
    schema = "conv_id long, turn long, role string, text string, ids string, mask int"
    odd = spark.createDataFrame([(*r, "clash", 1) for r in given if rows == "odd"], schema)
    odd.write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = both(spark, str(tmp_path))
    assert got == want and len(got) == (8 if rows == "odd" else 1)
