import hashlib
import random
import re

import pytest

from catalign.llm import piece_table
from catalign.llm.piece_table import PieceTable


def _plain(key, text):
    """(n, form, prefix, middle, suffix, output) by the words of the contract."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("window", [7, 1 << 20])
def test_against_brute_force(monkeypatch, window):
    """A small window cuts runs of letters and code points at every place."""
    monkeypatch.setattr(piece_table, "WINDOW", window)
    rnd = random.Random(4)
    for key in range(400):
        text = "".join(rnd.choices(["a", "Zz", " ", "\n", "é", "日", "😀", "7", "<P", "S>", "<M>", "[", "`", "{", "@"], k=rnd.randrange(0, 40)))
        table, form, n = piece_table.build(str(key), text.encode())
        want = _plain(key, text)
        assert (n, form, table.content().decode(), table.sha256()) == (want[0], want[1], want[4], _sha(want[4]))
        back = piece_table._restored(table.content(), form)
        assert back.content().decode() == text and back.sha256() == _sha(text)


def test_pieces_are_never_copied():
    table = PieceTable(b"one two")
    table.cut(3)
    table.cut(4)
    assert table.pieces == [(0, 0, 3), (0, 3, 1), (0, 4, 3)]
    table.arrange("spm")
    assert table.pieces == [(1, 3, 3), (0, 4, 3), (1, 0, 3), (0, 0, 3), (1, 6, 3), (0, 3, 1)] and table.content() == b"<S>two<P>one<M> "
    table.restore("spm")
    assert table.content() == b"one two" and table.buffers[1] == piece_table.SENTINELS
    with pytest.raises(ValueError):
        PieceTable(b"one").cut(4)
    with pytest.raises(ValueError):
        PieceTable.of_output(b"x<P>a<S>b<M>c", "psm")


def test_digest_of_rows(docs, empty_docs):
    got = sorted((tuple(r) for r in piece_table.digest(docs).collect()), key=repr)
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, form, p, m, output = _plain("" if r.doc_id is None else r.doc_id, r.text or "")
        want.append((r.doc_id, n, form, p, m, _sha(output), _sha(r.text or "")))
    assert got == sorted(want, key=repr)
    assert {form for _, _, form, *_ in got} == {"plain", "psm", "spm"} or len(got) == 12
    assert piece_table.digest(empty_docs).count() == 0


def test_outputs_and_restored(docs, empty_docs):
    made = piece_table.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "fim_form", "fim_text"]
    rows = piece_table.restored(made).collect()
    assert all(r.restored == (r.text or "") for r in rows) and len(rows) == docs.count()
    for r in rows:
        assert (r.fim_form, r.fim_text) == _plain("" if r.doc_id is None else r.doc_id, r.text or "")[1::3]
    assert piece_table.restored(piece_table.fill_in_middle(empty_docs)).count() == 0
    with pytest.raises(ValueError):
        piece_table.fill_in_middle(made)


def test_piece_tables(docs):
    texts = {(r.doc_id, r.n): r for r in piece_table.piece_tables(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        key, body = "" if r.doc_id is None else r.doc_id, (r.text or "").encode()
        n, form, _, _, output = _plain(key, r.text or "")
        found = texts[(r.doc_id, n)]
        buffers = (body, piece_table.SENTINELS)
        assert found.form == form and b"".join(buffers[p.buffer][p.start:p.start + p.size] for p in found.pieces).decode() == output
