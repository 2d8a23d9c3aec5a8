"""Chat formatting: a hidden Markov model recovers roles from transcript lines, then turns are rendered alike."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ["system", "user", "assistant"]
#: Names of speakers in markers.
SPEAKERS = {"system": 0, "instructions": 0, "user": 1, "human": 1, "q": 1, "assistant": 2, "bot": 2, "a": 2, "ai": 2}
MARKER = re.compile(r"^\s*(?:#+\s*|<\|)?(system|instructions|user|human|q|assistant|bot|ai|a)(?:\|>|\s*:|\s*$)\s*", re.I)
#: Conversations from which the probabilities are counted: those with the smallest hash, a bounded sample.
MOST_CONVERSATIONS = 2_000
N_MARKS, N_SHAPES = 5, 12


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcript lines of the stored conversations: conv_id, turn, pos, line, plus the true role.

    The marker style hangs on the conversation; in a quarter of them every third turn or so has only a blank line before it.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    speaker = lambda *names: F.element_at(F.create_map(*[F.lit(x) for p in zip(ROLES, names) for x in p]), F.col("role"))
    marker = (F.when(style == 0, F.concat(speaker("System", "User", "Assistant"), F.lit(": ")))
              .when(style == 1, F.concat(speaker("Instructions", "Q", "A"), F.lit(": ")))
              .when(style == 2, F.concat(F.lit("### "), speaker("System", "Human", "Assistant"), F.lit("\n")))
              .otherwise(F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0, F.lit("\n"))
                         .otherwise(F.concat(F.lit("<|"), speaker("system", "user", "assistant"), F.lit("|>")))))
    known = F.when(F.col("role").isin(ROLES), marker).otherwise(F.lit("\n"))
    return conversations.select("conv_id", "turn", "role", F.posexplode(F.split(F.concat(known, F.coalesce("text", F.lit(""))), "\n")).alias("pos", "line"))


def observe(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per line the speaker marker (0 none, 1 to 3 the role, 4 blank) and a code of its shape."""
    marks, shapes = [], []
    for i, line in enumerate(lines):
        m = MARKER.match(line)
        rest = line[m.end():] if m else line
        marks.append(1 + SPEAKERS[m[1].lower()] if m else 4 if not line.strip() else 0)
        before = i > 0 and not lines[i - 1].strip()
        shapes.append((len(rest) > 60) + (len(rest) > 200) + 3 * ("?" in rest) + 6 * before)
    return np.array(marks, int), np.array(shapes, int)


def train(lines: DataFrame, most: int = MOST_CONVERSATIONS) -> dict[str, np.ndarray]:
    """Log probabilities counted with add-one smoothing. A state is role * 2 + (0 first line of a turn, 1 later line)."""
    some = lines.select("conv_id").distinct().orderBy(F.xxhash64("conv_id"), "conv_id").limit(most)
    rows = lines.join(some, "conv_id").where(F.col("role").isin(ROLES)).toPandas().sort_values(["conv_id", "turn", "pos"])
    start, move = np.ones(6), np.ones((6, 6)) * 0.05
    marks, shapes = np.ones((6, N_MARKS)) * 0.05, np.ones((6, N_SHAPES))
    for _, conv in rows.groupby("conv_id", sort=True):
        turns = conv["turn"].to_numpy()
        first = np.concatenate([[True], turns[1:] != turns[:-1]])
        s = np.array([ROLES.index(r) for r in conv["role"]]) * 2 + ~first
        m, f = observe([x or "" for x in conv["line"]])
        start[s[0]] += 1
        np.add.at(move, (s[:-1], s[1:]), 1)
        np.add.at(marks, (s, m), 1)
        np.add.at(shapes, (s, f), 1)
    move[:, 1::2] *= np.kron(np.eye(3), np.ones((2, 1))) + 1e-9  # a later line belongs to the turn before it
    log = lambda x: np.log(x / x.sum(-1, keepdims=True))
    start[1::2] = 1e-9
    return {"start": log(start), "move": log(move), "marks": log(marks), "shapes": log(shapes)}


def viterbi(lines: list[str], model: dict[str, np.ndarray]) -> np.ndarray:
    m, f = observe(lines)
    emit = model["marks"][:, m].T + model["shapes"][:, f].T
    score, back = model["start"] + emit[0], np.zeros((len(lines), 6), np.int8)
    for i in range(1, len(lines)):
        ways = score[:, None] + model["move"]
        back[i] = ways.argmax(0)
        score = ways.max(0) + emit[i]
    out = np.zeros(len(lines), int)
    out[-1] = score.argmax()
    for i in range(len(lines) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def render(lines: list[str], states: np.ndarray) -> list[tuple[str, str, str]]:
    """(role, text, canonical rendering) of each recovered turn; markers go, blank ends are trimmed."""
    turns: list[tuple[str, list[str]]] = []
    for line, state in zip(lines, states):
        if state % 2 == 0 or not turns:
            turns.append((ROLES[state // 2], []))
        m = MARKER.match(line) if state % 2 == 0 else None
        turns[-1][1].append(line[m.end():] if m else line)
    texts = [(role, "\n".join(x).strip()) for role, x in turns]
    return [(role, text, f"<|{role}|>\n{text}\n<|end|>") for role, text in texts]


def parse(lines: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """conv_id, turn_no, role, text and rendered for each recovered turn of each transcript.

    ``lines`` has conv_id, line and its order (turn, pos). Lines are sorted within partitions and read as a stream; one
    transcript is held at a time, a few bytes a line beside its text. Null lines count as blank; lines without conv_id
    are one transcript; equal transcripts give equal turns; no lines give no rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def turns(conv_id, held):
            for i, (role, text, rendered) in enumerate(render(held, viterbi(held, model))):
                yield (conv_id, i, role, text, rendered)

        now, held, out, empty = None, [], [], True
        columns = ["conv_id", "turn_no", "role", "text", "rendered"]
        for batch in batches:
            for conv_id, line in zip(batch["conv_id"], batch["line"]):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if not empty and conv_id != now:
                    out += turns(now, held)
                    held = []
                now, empty = conv_id, False
                held.append(line if isinstance(line, str) else "")
            if len(out) > 2_000:
                yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
                out = []
        if held:
            out += turns(now, held)
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})

    rows = lines.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "pos", "line").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "pos")
    return rows.select("conv_id", "line").mapInPandas(run, "conv_id long, turn_no long, role string, text string, rendered string")
