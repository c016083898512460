import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import rows
from wardlog.llm import chat as C
from wardlog.llm.columns import text_bytes

import pyarrow as pa

HARD = [None, "", "<|im_end|>", "<|im_start|>user\n", "<\\|x", "<\\\\|im_end|>", "<", "<|", "|", "\\|", "<<|", "a<|b<\\|c<\\\\|d", "é😀<|\n", "\\", "<\\"]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, loss_from string"


def assembled(role, texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    header = C.START + C._escape_role(role.encode()) + b"\n"
    out, at, begin, end = C.assemble([header], np.zeros(len(texts), np.int64), data, offsets)
    return [(out[a:b].tobytes(), int(i), int(j)) for a, b, i, j in zip(at, at[1:], begin, end)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="u\\\n<|x", max_size=6), st.lists(st.text(alphabet="<|\\ab\né😀", max_size=12), min_size=1, max_size=6))
def test_turns_survive(role, texts):
    for text, (formatted, i, j) in zip(texts, assembled(role, texts)):
        assert C.read_turn(formatted) == (role.encode(), text.encode())
        assert C.unescape(formatted[i:j]) == text.encode()
        assert formatted.count(b"<|") == 2


def expected(turns):
    convs = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, assembled(role or "", [text or ""])[0][0], role or "", text or ""))
    out = []
    for conv, items in convs.items():
        items.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in items)
        loss = "".join(t for *_, r, t in items if r == "assistant")
        out.append((conv, len(items), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(f.decode()) for _, _, f, *_ in items)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [1 << 20, 5])
def test_read_back(spark, blocks, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", blocks)
    rng = random.Random(4)
    turns = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\nrole<|"]), rng.choice(HARD)) for c in [1, 2, 3, None, -7] for t in range(9)]
    turns += [turns[0], turns[0], (2, None, "assistant", "first"), (2, 3, "assistant", "tie"), (4, 0, "user", "x" * 300_000 + "<|")]
    turns += [(5, t, "assistant", f"turn {t} <|im_end|>") for t in range(3000)]  # one long conversation
    rng.shuffle(turns)
    df = spark.createDataFrame([(*t, "clash", "clash") for t in turns], SCHEMA).repartition(6)
    assert rows(C.read_back(C.format_turns(df))) == expected(turns)
    assert C.format_turns(df).count() == len(turns)


def test_empty(spark):
    assert C.read_back(C.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0


def test_foreign_control_strings_are_refused():
    with pytest.raises(ValueError):
        C.read_turn(b"<|im_start|>user\na<|im_end|>b<|im_end|>\n")
    with pytest.raises(ValueError):
        C.read_turn(b"user\nabc")


def test_query_has_the_probe(spark, sf_small):
    found = {r["conv_id"]: r for r in C.op6_chat_format(spark, sf_small).collect()}
    assert found[-1]["loss_sha256"] == hashlib.sha256(C.PROBE.encode()).hexdigest() and found[-1]["n_turns"] == 2
    assert found[-1]["formatted_chars"] > 2 * len(C.PROBE)
