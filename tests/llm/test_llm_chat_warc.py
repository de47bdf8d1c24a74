import gzip
import hashlib
import random

from catalign.llm import chat_format, common, warc


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_round_trip_merge_and_mask(spark, clash):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "<s", "[INST", "a<s>b\\", "", None, "é\n😀", "<", "\\[INST]"]
    rows = [(1, i, "user" if i % 3 == 0 else "assistant", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "assistant", "x"), (2, 1, "assistant", "y"), (2, None, None, "first"), (None, 1, "[/INST]", "odd role"), (3, 5, "user", "b"), (3, 5, "user", "a"), (3, 5, "user", "a")]
    out = chat_format.format_chats(clash(_turns(spark, rows)))
    got = {r.conv_id: r for r in out.withColumn("turns", chat_format.read_turns(out.formatted)).withColumn("loss", chat_format.loss_text(out.segments)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[:len(nasty)]]
    assert got[1].loss == "".join(t or "" for i, t in enumerate(nasty) if i % 3)
    assert [(t.role, t.text) for t in got[2].turns] == [("", "first"), ("assistant", "x"), ("assistant", "y")]
    assert got[2].formatted.endswith("[INST] assistant [/INST]x<s>y</s>") and got[2].loss == "xy"
    assert [(t.role, t.text) for t in got[None].turns] == [("[/INST]", "odd role")]
    assert [t.text for t in got[3].turns] == ["a", "a", "b"]
    assert all("".join(s.text for s in r.segments) == r.formatted for r in got.values())


def test_only_spark_expressions(spark):
    plan = chat_format.digest(chat_format.format_chats(_turns(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_conversations(spark):
    assert chat_format.digest(chat_format.format_chats(_turns(spark, []))).count() == 0


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[(i // 3) % 2], f"t{i}") for i in range(3000)]
    row = chat_format.digest(chat_format.format_chats(_turns(spark, rows))).first()
    assert row.n_turns == 3000
    assert row.turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in rows).encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256("".join(r[3] for r in rows if r[2] == "assistant").encode()).hexdigest()


def test_archives_round_trip(spark, clash):
    big = "<p>" + "ä" * 800 + "</p>"
    rows = [(1, "u1", big), (2, "u2", big), (9, "u\r\nWARC-Type: x", big), (9, "u9", big), (None, None, big), (3, "s", "small"), (4, "s", "small"), (5, None, None), (6, "", ""), (-7, "x", "y" * 5_000_000)]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    path = common.fresh_path(spark, "test")
    warc.write(pages, path)
    records = warc.read(spark, path)
    assert records.filter("kind = 'gap'").count() == 0
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.page_records(records).collect()), key=repr)

    def want(page_id, html):
        data = (html or "").encode()
        same = html == big
        return (page_id, "revisit" if same and page_id != 9 else "response", 9 if same and page_id != 9 else None, len(data), hashlib.sha1(data).hexdigest())

    assert got == sorted((want(r[0], r[2]) for r in rows), key=repr)
    assert {bytes(r.payload).decode() for r in records.filter("type = 'response'").collect()} == {r[2] or "" for r in rows}
    names = [f.path.removeprefix("file:") for f in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert sum(gzip.open(n).read().count(b"WARC/1.1\r\n") for n in names) == len(rows)


def test_empty_pages(spark):
    path = common.fresh_path(spark, "test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0


def _record(i, size=300):
    return warc.record(i, f"u{i}", bytes(random.Random(i).choices(b"abc \n", k=size)), None, False)


def _ids(data):
    items = list(warc.salvage(data))
    at = 0
    for _, start, end, _ in items:
        assert start >= at
        at = end
    return [i[3]["warc-record-id"] for i in items if i[0] == "record"], [(i[1], i[2], i[3]) for i in items if i[0] == "gap"]


def test_salvage_of_damaged_members():
    members = [_record(i) for i in range(5)]
    name = lambda i: f"<urn:page:{i}>"
    begin = [sum(map(len, members[:i])) for i in range(6)]
    broken = bytearray(b"".join(members))
    broken[begin[2] + 60] ^= 0xFF
    ids, gaps = _ids(bytes(broken))
    assert ids == [name(i) for i in (0, 1, 3, 4)] and [g[:2] for g in gaps] == [(begin[2], begin[3])]
    ids, gaps = _ids(b"junk" + members[0] + b"\x1f\x8b\x08more junk" + members[1] + members[2][:-9])
    assert ids == [name(0), name(1)] and len(gaps) == 3
    ids, gaps = _ids(members[0] + warc.EMPTY_MEMBER + members[1])
    assert ids == [name(0), name(1)] and not gaps
    assert _ids(b"") == ([], [])


def test_salvage_of_plain_records():
    plain = [gzip.decompress(_record(i)) for i in range(4)]
    wrong = plain[1].replace(b"Content-Length: ", b"Content-Length: 1")
    ids, gaps = _ids(plain[0] + wrong + plain[2] + b"tail")
    assert ids == ["<urn:page:0>", "<urn:page:2>"]
    assert [g[:2] for g in gaps] == [(len(plain[0]), len(plain[0]) + len(wrong)), (len(plain[0]) + len(wrong) + len(plain[2]), len(plain[0]) + len(wrong) + len(plain[2]) + 4)]
    changed = plain[1].replace(b"\r\n\r\n", b"\r\n\r\n", 1)[:-10] + b"X" + plain[1][-9:]
    ids, gaps = _ids(changed + plain[3] + _record(7))
    assert ids == ["<urn:page:3>", "<urn:page:7>"] and gaps[0][2] in ("block digest", "payload digest")
