"""The corpus queries against their SQL, over whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from feedkit.llm.queries import ORACLE, QUERIES
from tests.compare import DATA, compare, connect

PATH = f"{DATA}/sf0.001"

pytestmark = pytest.mark.skipif(not Path(PATH).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    assert compare(spark, connect(PATH), PATH, name, QUERIES[name], ORACLE[name]) is None


def test_escapes_count_in_the_length():
    """The SQL's regular expression escapes what the operator escapes."""
    import duckdb
    import pyarrow as pa

    from feedkit.llm import chat

    texts = ["</s>", "\\\\</s> a<s>", "[INST][/INST]", "<|im_start|>x\\<|im_end|>", "\\", "", "< s>", "<<SYS>> <</SYS>>"]
    sql = ORACLE["op9_chat"]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, 0, 'user', ?)", [[i, t] for i, t in enumerate(texts)])
    got = dict(con.execute(f"SELECT conv_id, formatted_chars FROM ({sql}) WHERE conv_id >= 0").fetchall())
    frame = len(f"{chat.START}user\n\n{chat.END}\n")
    assert got == {i: frame + len(t) for i, t in enumerate(chat.escape(pa.array(texts)).to_pylist())}
