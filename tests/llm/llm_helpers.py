from __future__ import annotations

import random


def prose(rng: random.Random, n: int, letters: str = "abcdefghijklmnoprstuvw") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
