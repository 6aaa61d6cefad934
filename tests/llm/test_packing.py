"""Best-fit decreasing against a plain search, and pieces against the tokenizer library."""
import random
import zlib

import numpy as np

from corpusprep.llm.packing import best_fit_decreasing, pieces, place, sequences
from corpusprep.llm.queries import tokenizer_path
from corpusprep.llm.tokens import encoder


def test_best_fit_equals_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        x = np.array([rng.randint(1, 64) for _ in range(rng.randint(0, 90))], dtype=np.int64)
        of, offset, used = best_fit_decreasing(x, 64)
        room: list[int] = []
        for i in np.argsort(-x, kind="stable"):
            fits = sorted((r, k) for k, r in enumerate(room) if r >= x[i])
            if fits:
                room[fits[0][1]] -= x[i]
                assert 64 - offset[i] >= x[i]
            else:
                room.append(64 - x[i])
        fill = np.bincount(of, weights=x, minlength=used) if len(x) else np.zeros(0)
        assert used == len(room) and sorted(64 - fill) == sorted(room)


def test_place_covers_every_token():
    tokens = np.array([1, 1024, 1025, 5000, 7, 7, 2048])
    doc, start, length, seq, offset, used = place(tokens, 1024)
    assert (np.bincount(doc, weights=length) == tokens).all() and seq.max() + 1 == used
    for d in range(len(tokens)):
        spans = sorted(zip(start[doc == d], length[doc == d]))
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_pieces_equal_library(spark, odd, none):
    from tokenizers import Tokenizer

    rows, df = odd
    lib = Tokenizer.from_file(tokenizer_path())
    for t in ["", "don't 's ''s I'LL", "<|endoftext|> x", " \n\t 　x\r\n ", *(t for _, t in rows if t)]:
        assert encoder(tokenizer_path())(t).tolist() == lib.encode(t, add_special_tokens=False).ids
    found = pieces(df, tokenizer_path(), with_ids=True).cache()
    got = found.collect()
    want = sorted((str(d), len(lib.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in got if r["start"] == 0) == want
    by: dict = {}
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    for parts in by.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    packed = {r["sequence_id"]: r for r in sequences(found).collect()}
    assert packed.keys() == by.keys()
    for k, parts in by.items():
        flat = [x for _, _, ids in sorted(parts) for x in ids]
        assert packed[k]["ids"][: len(flat)] == flat
        assert len(packed[k]["ids"]) in (1024, len(flat)) and (len(packed[k]["ids"]) == 1024 or len(flat) & (len(flat) - 1) == 0)
    assert pieces(none, tokenizer_path()).collect() == []


def test_added_tokens_equal_library(tmp_path):
    """Strings of added tokens: at both ends, doubled, beside spaces, cut short, one inside another."""
    import json

    from tokenizers import Tokenizer

    with open(tokenizer_path(), encoding="utf-8") as f:
        model = json.load(f)
    base = max(t["id"] for t in model["added_tokens"])
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    model["added_tokens"] += [{"id": base + 1 + i, "content": c, **flags} for i, c in enumerate(("<|a|>", "<|a|>b", "<|é🎉|>"))]
    more = tmp_path / "more.json"
    more.write_text(json.dumps(model), encoding="utf-8")
    lstrip = tmp_path / "lstrip.json"
    model["added_tokens"][-1]["lstrip"] = True
    lstrip.write_text(json.dumps(model), encoding="utf-8")
    for path in (tokenizer_path(), str(more), str(lstrip)):
        lib, encode = Tokenizer.from_file(path), encoder(path)
        contents = [t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]]
        assert contents
        for t in contents:
            for text in (t, t + t, f"hello {t} world", f"{t}x", f"x{t}", f" {t} ", f"  {t}\n\n{t}  ", t[:-1], t[1:], t[:-1] + t, f"a{t}{t[0]}", f"don{t}'t", f"{' ' * 120_000}{t}{' ' * 120_000}"):
                assert encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids, (path, text[:40])
        rng = random.Random(len(contents))
        for _ in range(300):
            text = "".join(rng.choice([*contents, "<|", "|>", " ", "a", "b", "\n", "é", "'s"]) for _ in range(rng.randint(1, 12)))
            assert encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids, (path, text)


def test_long_white_space_runs():
    from tokenizers import Tokenizer

    from corpusprep.llm.tokens import LONG, LONG_SPACE

    lib = Tokenizer.from_file(tokenizer_path())
    encode = encoder(tokenizer_path())
    blank = " " * 2_000_000
    for t in (blank, blank + "after", "before" + blank, f"in{blank}side", f"in {blank}\n'side"):
        assert encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids
    for n in (LONG - 1, LONG, LONG + 1):
        for run in (" " * n, "\n" * n, "\u3000" * n, "\r\n\x85\xa0 "[: n % 5 + 1] * (n // 3)):
            for t in (run, f"a{run}b", f"{run}'s", f"1{run}\x1c", f"{run}.{run}x "):
                assert encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids
    for c in "a1.\x1c":
        assert encode(c * 1_200_000).tolist() == lib.encode(c * 1_200_000, add_special_tokens=False).ids
    assert [bool(LONG_SPACE.match(chr(c) * LONG)) for c in (9, 13, 28, 31, 32, 133, 160, 0x180E, 0x200A, 0x200B, 0x3000)] == [
        True, True, False, False, True, True, True, False, True, False, True]
