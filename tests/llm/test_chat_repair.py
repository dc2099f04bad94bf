"""Chat examples and conversation repair against plain Python."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import cache

import pytest

from firmlens.llm import chat, repair

SCHEMA = "conv_id long, turn long, role string, text string, position int, start string, audit string, _row int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(3)


ROWS = [
    (1, 0, "system", "Be kind. "), (1, 1, "user", "### user: </turn> \\ ## #### <</ \\/"), (1, 2, "assistant", "\\### Assistant: </turn> ok"), (1, 3, "user", "a\n### x: y</turn>\nz"), (1, 4, "assistant", ""),
    (2, 0, "user", "no reply?"), (2, None, "user", "first"), (3, 5, "assistant", "ü" * 50_000 + "#</turn"), (3, 5, "assistant", "same turn"), (3, 6, "user", None),
    (None, 1, None, None), (None, None, "a:b\\:c ### </turn>", "#"), (4, 1, "user", "twice"), (4, 1, "user", "twice"), (4, 1, "assistant", "twice"), (4, 2, "assistant", "end\\"), (5, 1, "", "\n"),
]


def _ordered(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        found[conv].append(((turn is not None, turn or 0, role, zlib.crc32(text.encode())), role, text))
    return {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in found.items()}


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_round_trip(spark, tmp_path):
    files = chat.write_chat(_frame(spark, ROWS), str(tmp_path / "chat"))
    want = _ordered(ROWS)
    turns = defaultdict(dict)
    for r in chat.read_turns(spark, files).collect():
        turns[r.conv_id][r.position] = (r.role, r.text)
        assert r.formatted.count("###") == 1 and r.formatted.count("</turn>") == 1
    assert {c: [v[k] for k in range(len(v))] for c, v in turns.items()} == want
    got = {r.conv_id: r for r in chat.digests(spark, files).collect()}
    assert set(got) == set(want)
    for conv, rows in want.items():
        replies = [t for r, t in rows if r == "assistant"]
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(rows), _sha("".join(f"{a}\n{b}\n" for a, b in rows)))
        assert (r.loss_chars, r.loss_sha256) == (sum(map(len, replies)), _sha("".join(replies)))


def test_examples_hold_all_turns_before_their_reply(spark, tmp_path):
    files = chat.write_chat(_frame(spark, ROWS), str(tmp_path / "chat"))
    examples = spark.read.parquet(files.examples)
    texts = chat.example_texts(spark, files, examples).collect()
    formatted = defaultdict(dict)
    for r in chat.read_turns(spark, files).collect():
        formatted[r.conv_id][r.position] = r.formatted
    for conv, rows in _ordered(ROWS).items():
        mine = sorted((e for e in texts if e.conv_id == conv), key=lambda e: e.position)
        replies = [k for k, (role, _) in enumerate(rows) if role == "assistant"]
        last = [] if replies and replies[-1] == len(rows) - 1 else [len(rows) - 1]
        assert [e.position for e in mine] == replies + last
        for e in mine:
            assert e.text == "".join(formatted[conv][k] for k in range(e.position + 1)) and len(e.text) == e.text_chars
            if e.position in replies:
                inside = re.sub(r"(?s)\\(.)", r"\1", e.text[e.loss_start : e.loss_end])
                assert inside == rows[e.position][1] and e.text[e.loss_end :] == "</turn>\n"
            else:
                assert e.loss_start is None and e.loss_end is None
    total = {r.conv_id: r.formatted_chars for r in chat.digests(spark, files).collect()}
    assert total == {c: sum(e.text_chars for e in texts if e.conv_id == c) for c in total}


def test_long_conversation_takes_a_row_per_turn(spark, tmp_path):
    rows = [(7, k, ("user", "assistant")[k % 2], f"text {k}") for k in range(3000)]
    files = chat.write_chat(_frame(spark, rows), str(tmp_path / "chat"))
    assert spark.read.parquet(files.turns).count() == 3000 and spark.read.parquet(files.examples).count() == 1500
    assert chat.digests(spark, files).first().n_turns == 3000


def test_examples_are_written_in_full(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 3)  # conversations of several chunks, with and without a reply in the last one
    rows = ROWS + [(c, k, "assistant" if k % 4 == 1 and (c != 9 or k < 9) else "user", f"turn {k} of {c}") for c in (8, 9, 10) for k in range(12 + c)]
    rows += [(11, k, "user", str(k)) for k in range(7)] + [(12, k, "assistant", str(k)) for k in range(6)]
    files = chat.write_chat(_frame(spark, rows), str(tmp_path / "chat"))
    formatted = defaultdict(dict)
    for r in chat.read_turns(spark, files).collect():
        formatted[r.conv_id][r.position] = r.formatted
    want = {}
    for conv, turns in _ordered(rows).items():
        for k, (role, _) in enumerate(turns):
            if role == "assistant" or k == len(turns) - 1:
                want[conv, k] = "".join(formatted[conv][j] for j in range(k + 1))
    found = spark.read.parquet(files.examples).collect()
    assert len(found) == len(want) and {(r.conv_id, r.position): r.text for r in found} == want
    slim = spark.read.parquet(files.examples).drop("text")
    assert {(r.conv_id, r.position): r.text for r in chat.example_texts(spark, files, slim).collect()} == want


def test_chat_of_nothing(spark, tmp_path):
    files = chat.write_chat(_frame(spark, ROWS).limit(0), str(tmp_path / "chat"))
    assert chat.digests(spark, files).count() == 0


sys.setrecursionlimit(20_000)


def _brute(codes):
    """Cheapest edits, ASCII-least among equals, from the rear: best (cost, audit) of the rows from i on after a state."""
    @cache
    def best(i, state, inserts):
        found = []
        if i == len(codes) and state in ("", "a"):
            found.append((0, ""))
        if inserts < 2:
            to = "a" if state == "u" else "u"
            cost, audit = best(i, to, inserts + 1)
            found.append((cost + 2, "I" + audit))
        if i < len(codes):
            code, more = codes[i].lower(), int(codes[i].isupper())
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit))
            if code != "x":
                to = "a" if state == "u" else "u"
                cost, audit = best(i + 1, to, 0)
                found.append((cost + 2 + more, "R" + audit))
                if state + code in ("s", "u", "su", "ua", "au"):
                    cost, audit = best(i + 1, code, 0)
                    found.append((cost + more, "K" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def test_search_is_optimal():
    rng = random.Random(3)
    for _ in range(3000):
        codes = "".join(rng.choice("usaouuaaUSAOx") for _ in range(rng.randrange(0, 11)))
        assert repair.search(codes) == _brute(codes), codes
        assert repair.Bounds(codes).after(0, "") <= repair.search(codes)[0], codes


def test_search_of_a_block_of_random_roles_is_short():
    rng = random.Random(4)
    for _ in range(20):
        codes = "".join(rng.choice("uuaaUAsox") for _ in range(repair.BLOCK))
        assert repair.search(codes) == _brute(codes)


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_compose_to_the_whole(block):
    rng = random.Random(block)
    for _ in range(400):
        codes = "".join(rng.choice("usaouaUAxx") for _ in range(rng.randrange(1, 16)))
        composer = repair.Composer()
        for at in range(0, len(codes), block):
            cells = [(e, x, *b) for e in repair.STATES for x in repair.STATES if (b := repair.search(codes[at : at + block], e, (x,)))]
            composer.add(*map(list, zip(*cells)))
        assert composer.result() == _brute(codes), codes


def _damage(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range(1 + (kind == 3)):
            yield conv, turn, role, text


def _expected(rows):
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text in _damage(rows):
        found[conv].append((turn, role, text))
    for conv, mine in found.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], zlib.crc32(r[2].encode())))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, codes, faults = set(), "", defaultdict(int)
        for _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            letter = role[:1] if role[:1] in ("u", "s", "a") else "o"
            codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = _brute(codes)
        lines, at, state = [], 0, ""
        for edit in audit:
            if edit == "K":
                state = mine[at][1][0]
                lines.append(f"{mine[at][1]}:{mine[at][2]}")
            elif edit in "IR":
                state = "a" if state == "u" else "u"
                lines.append(f"{'user' if state == 'u' else 'assistant'}:{mine[at][2] if edit == 'R' else ''}")
            at += edit != "I"
        yield conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, _sha("\n".join(lines))


def _texts(rng):
    return rng.choice(["Yes.", "no", "", None, " \t\n", "Why? ", "ok!", " ", "x" * 3000, "End.\x0b"])


def test_repair_of_damaged_conversations(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *range(40)]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "über"]), _texts(rng)) for _ in range(500)]
    rows += rng.sample(rows, 20)
    rows += [(1000 + k, 0, "user", "Hello.") for k in range(60)]  # some of them lose their only row
    for block in (128, 4):
        monkeypatch.setattr(repair, "BLOCK", block)
        got = {tuple(r) for r in repair.repair_damaged(_frame(spark, rows)).collect()}
        assert got == set(_expected(rows))
    gone = [r for r in got if r[7] == "" and r[0] is not None and r[0] >= 1000]
    assert gone and gone[0][8] == _sha("")


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"word {k}", f"{k}."])) for k in range(700)] + [(k, 0, "user", "Hi.") for k in range(2, 9)]
    assert {tuple(r) for r in repair.repair_damaged(_frame(spark, rows)).collect()} == set(_expected(rows))


def test_repair_of_nothing(spark):
    assert repair.repair_damaged(_frame(spark, ROWS).limit(0)).count() == 0
