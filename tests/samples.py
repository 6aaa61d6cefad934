"""Test inputs shared by several test files."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def synthetic_pairs(n: int = 64) -> list[dict]:
    """Our own bilingual rows: plain sentences, no-break spaces, quotes, one short row, lengths from 3 to 60 words."""
    import random

    rng = random.Random(64)
    en = "the a house river small old runs sees Mr. we're time-table light, over under yes two 1999 green \"quoted\" it's".split()
    fr = "le la maison rivière petite vieux court voit M. l'été emploi lumière, sur sous oui deux 1999 vert «\u00a0cité\u00a0» n'est".split()
    rows = []
    for i in range(n):
        k = 3 if i == 54 else rng.randint(4, 46)
        m = 4 if i == 54 else max(4, min(60, k + rng.randint(-1, k // 2)))
        end = "\u00a0!" if i % 5 == 0 else "."
        rows.append({"en": " ".join(rng.choice(en) for _ in range(k)) + ("" if i % 3 else " "), "fr": " ".join(rng.choice(fr) for _ in range(m)) + end})
    return rows


# Adversarial strings for text parity (FIXTURES §3).
ADVERSARIAL = [
    "It's a \"quote\" test",
    "only 'single' quotes",
    'only "double" quotes',
    "back\\slash",
    "tab\there\nnewline",
    "nbsp thin ideo　nel\u0085fs\u001czwsp​del\u007f",
    "emoji \U0001F600 ok",
    "",
    " ",
    " ",
    "  spaced  out  ",
    "ctrl\x01\x08bell\rcr",
    "﻿bom ls ps­shypua",
]
