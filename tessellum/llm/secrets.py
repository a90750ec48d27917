"""Secret scan: fixed patterns and character Markov models of tokens.

Markov models of the characters of tokens, of random strings and of ordinary
identifiers and words, are trained from labelled samples, a pair of them for each
alphabet: which of lower-case letters, capitals, digits and signs a token holds.
A candidate token is a secret if its mean log-likelihood ratio per character under
the pair of its alphabet is above a threshold; nothing else decides.  The spans of
the fixed patterns stand whatever the models say.
"""

from __future__ import annotations

import hashlib
import importlib
import random
import re
import string
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")


@dataclass(frozen=True)
class SecretScan:
    """Parameters.

    threshold: least mean log-likelihood ratio of a random token, in nats per character.
    samples: tokens of each class that are drawn for the default models.
    seed: of those samples.
    smoothing: what each character of an alphabet adds to the counts.
    """

    threshold: float = 0.5
    samples: int = 12_000
    seed: int = 20
    smoothing: float = 0.5


# Ordinary words, of English names in programs and of the prose of four languages.
PARTS = (
    "get set new old max min sum count index value name user data file path list item node tree table column row page line word text "
    "string number array object class method function module package import export return result error message request response client "
    "server host port config option default parser reader writer buffer stream input output event handler listener callback manager"
).split()
WORDS = {
    "en": "the and that which their about would there people through where should because however international organization information "
    "development government university different important following environment available knowledge relationship understanding straight",
    "de": "der und nicht eine werden zwischen gesellschaft wissenschaft wirtschaft entscheidung geschwindigkeit verantwortung zusammenhang "
    "schwierigkeiten jahrhundert schreibtisch rechtsprechung beziehungsweise gleichzeitig selbstverständlich arbeitsplatz versicherung",
    "fr": "les des une pour dans avec notamment aujourd développement gouvernement établissement connaissance lorsque quelques beaucoup "
    "toujours ailleurs heureusement environnement enseignement question croissance bouleversement quotidien auxquelles",
    "es": "los las una por con para desarrollo gobierno conocimiento establecimiento siguiente mientras también entonces cualquier "
    "trabajadores universidad organización especialmente aproximadamente guerra quienes izquierda derecho",
}
#: Modules of the standard library whose names are samples of identifiers.
LIBRARY = "argparse ast asyncio codecs collections configparser ctypes datetime decimal email.message http.client inspect json logging os pathlib pickle re shutil socket sqlite3 ssl string subprocess tarfile threading tokenize typing unittest urllib.request xml.dom.minidom zipfile".split()

_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALPHABETS = (
    _DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _LOWER + _DIGITS, _UPPER + _DIGITS, _LOWER, _UPPER, _LOWER + _UPPER,
    _LOWER + _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS + "+/", _LOWER + _UPPER + _DIGITS + "-_",
)


def library_names() -> list[str]:
    """The names that modules of the standard library, and their classes, define: identifiers as programs hold them."""
    found: set[str] = set()
    for name in LIBRARY:
        module = importlib.import_module(name)
        found.update(dir(module))
        for x in vars(module).values():
            if isinstance(x, type):
                found.update(dir(x))
    return sorted(x for x in found if len(x) >= 6 and x.isascii())


def _plain(word: str) -> str:
    """The word in ASCII letters alone: candidates hold no others."""
    return word.translate(str.maketrans("äöüßàâçéèêîôûñáíóú", "aousaaceeeiounaiou"))


def _ordinary(draw: random.Random, i: int) -> str:
    """The i-th ordinary token: identifiers, words side by side, paths, numbers, rules and, more seldom, UUIDs in turn."""
    language = draw.choice(list(WORDS))
    words = [_plain(x) for x in WORDS[language].split()] + PARTS * (language == "en")
    parts = [draw.choice(words) for _ in range(draw.randint(3, 9))]
    number = lambda: str(draw.randint(0, 2030))
    kinds = (
        lambda: "_".join(parts),
        lambda: "-".join(parts),
        lambda: parts[0] + "".join(x.title() for x in parts[1:]),
        lambda: "".join(x.title() for x in parts),
        lambda: "/".join(parts),
        lambda: "".join(parts),
        lambda: "".join(parts).title(),
        lambda: "_".join(x.upper() for x in parts),
        lambda: "".join(x.upper() for x in parts),
        lambda: "/".join(x if draw.random() < 0.7 else number() for x in parts),
        lambda: "-".join(number() for _ in range(draw.randint(4, 8))),
        lambda: "".join(draw.choice(_DIGITS) for _ in range(draw.randint(20, 40))),
        lambda: "".join(x if draw.random() < 0.8 else x + str(draw.randint(0, 99)) for x in parts),
        lambda: draw.choice("-_=+/") * draw.randint(20, 90),
    )
    kind = i % (len(kinds) + 1)
    if kind == len(kinds):
        token = str(uuid.UUID(int=draw.getrandbits(128)))
        return token.upper() if draw.random() < 0.3 else token
    return kinds[kind]() + (draw.choice(["", *"_-="]) + number() if draw.random() < 0.3 else "")


def default_samples(p: SecretScan) -> list[tuple[str, int]]:
    """Labelled tokens: 1 for strings drawn from the alphabets that keys are written in, 0 for ordinary ones."""
    draw = random.Random(p.seed)
    out = [(x, 0) for x in library_names()]
    for i in range(p.samples):
        letters = ALPHABETS[i % len(ALPHABETS)]
        out.append(("".join(draw.choice(letters) for _ in range(draw.randint(20, 64))), 1))
        out.append((_ordinary(draw, i), 0))
    return out


# The four sorts of characters and the 16 alphabets, sets of them, that a token can have.
_SORT = np.full(128, 8, np.uint8)
_SORT[[ord(c) for c in _LOWER]], _SORT[[ord(c) for c in _UPPER]], _SORT[[ord(c) for c in _DIGITS]] = 1, 2, 4
_ALPHABETS = 16


def _codes(token: str) -> np.ndarray:
    return np.frombuffer(token.encode("ascii", "replace"), np.uint8) & 127


@dataclass
class MarkovPairs:
    """Of each alphabet the log-likelihood ratios, random against ordinary, of a first character and of each transition."""

    first: np.ndarray
    step: np.ndarray

    def ratio(self, token: str) -> float:
        """Mean log-likelihood ratio per character."""
        codes = _codes(token)
        if not len(codes):
            return 0.0
        alphabet = np.bitwise_or.reduce(_SORT[codes])
        return float((self.first[alphabet, codes[0]] + self.step[alphabet, codes[:-1], codes[1:]].sum()) / len(codes))


def train(samples: Iterable[tuple[str, int]], smoothing: float = 0.5) -> MarkovPairs:
    """The models of labelled tokens (text, 1 for random): smoothed counts of first characters and transitions."""
    rows = [(codes, label) for token, label in samples if len(codes := _codes(token))]
    every = np.concatenate([x for x, _ in rows] or [np.zeros(0, np.uint8)])
    begins = np.cumsum([0] + [len(x) for x, _ in rows])[:-1]
    alphabets = np.bitwise_or.reduceat(_SORT[every], begins) if rows else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    group = np.array([label for _, label in rows], np.int64) * _ALPHABETS + alphabets
    inner = np.setdiff1d(np.arange(len(every)), begins)
    shape = (2, _ALPHABETS, 128)
    first = np.bincount(group * 128 + every[begins], minlength=2 * _ALPHABETS * 128).reshape(shape).astype(float)
    pairs = (group[owner[inner]] * 128 + every[inner - 1]) * 128 + every[inner]
    step = np.bincount(pairs, minlength=2 * _ALPHABETS * 128 * 128).reshape(*shape, 128).astype(float)
    held = (_SORT & np.arange(_ALPHABETS)[:, None]) > 0
    return MarkovPairs(
        _ratio(first, held, smoothing).astype(np.float32),
        np.where(held[:, :, None], _ratio(step, held[:, None, :], smoothing), 0).astype(np.float32),
    )


def _ratio(counts: np.ndarray, held: np.ndarray, smoothing: float) -> np.ndarray:
    """Log-likelihood ratios, random against ordinary, over the last axis, of counts[class, alphabet, ...]; 0 outside the alphabet.

    Random strings are smoothed toward equal shares of their alphabet's characters,
    ordinary ones toward the ordinary tokens of all alphabets: an alphabet that
    few of them have is judged by what the others look like.
    """
    pooled = counts[0].sum(axis=0) + smoothing
    pooled = pooled / pooled.sum(axis=-1, keepdims=True)
    share = np.broadcast_to(held / np.maximum(held.sum(axis=-1, keepdims=True), 1), counts[1].shape)
    prior = smoothing * held.sum(axis=-1, keepdims=True)
    log = []
    for own, other in ((counts[0], pooled), (counts[1], share)):
        with np.errstate(divide="ignore", invalid="ignore"):
            log.append(np.log((own + prior * other) / (own.sum(axis=-1, keepdims=True) + prior)))
    return np.where(held, log[1] - log[0], 0.0)


def train_from(samples: DataFrame, rows: int = 100_000, smoothing: float = 0.5) -> MarkovPairs:
    """The models of samples(token, label), of which at most `rows`, taken by a hash, are learned from."""
    chosen = samples.select("token", "label").filter("token IS NOT NULL AND label IN (0, 1)").orderBy(F.xxhash64("token", "label"), "token").limit(rows)
    return train([(r["token"], int(r["label"])) for r in chosen.collect()], smoothing)


@lru_cache(maxsize=4)
def default_models(p: SecretScan) -> MarkovPairs:
    """The models of the default samples, trained on the driver and sent to the tasks (1 MB)."""
    return train(default_samples(p), p.smoothing)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, kinds numbered as in KINDS."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def model_spans(text: str, models: MarkovPairs, p: SecretScan) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the candidate tokens that the models take for random."""
    return [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text) if models.ratio(m.group()) >= p.threshold]


def _long_runs(block: at.TextBlock, table: np.ndarray, least: int) -> np.ndarray:
    """For each text, whether it holds a run of at least so many bytes of the table."""
    starts, ends = at.word_spans(block, block.data, table)
    long = starts[ends - starts >= least]
    return np.bincount(np.searchsorted(block.offsets, long, "right") - 1, minlength=len(block)) > 0


_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_HINT = re.compile(rb"pass(?:word|wd)|secret|token|api_?key", re.IGNORECASE)

SCANNED = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint, starts array<int>, ends array<int>"


def _digest(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan_text(text: str, models: MarkovPairs, p: SecretScan) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) of a text, by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + model_spans(text, models, p))


def _scan(batches: Iterator[pa.RecordBatch], p: SecretScan, models: MarkovPairs) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        for block in at.blocks(batch.column("text")):
            # a text is read closely only if it holds a long token or a key word
            close = _long_runs(block, _TOKEN, 20)
            raw = block.data.tobytes()
            hints = np.array([m.start() for m in _HINT.finditer(raw)], np.int64)
            close[np.searchsorted(block.offsets, hints, "right") - 1] = True
            n = len(block)
            counts, digests, spans = np.zeros((4, n), np.int64), [nothing] * n, [""] * n
            starts: list[list[int]] = [[] for _ in range(n)]
            ends: list[list[int]] = [[] for _ in range(n)]
            for i in np.flatnonzero(close).tolist():
                base, every = scan_text(block.text(i), models, p)
                for _, kind, _ in every:
                    counts[kind, i] += 1
                if every:
                    digests[i], spans[i] = hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(every)
                    starts[i], ends[i] = [a for a, _, _ in every], [b for _, _, b in every]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(block.first, n),
                    *(pa.array(counts[k]) for k in range(3)),
                    pa.array(digests),
                    pa.array(spans),
                    pa.array(counts[3]),
                    *(pa.array(x, pa.list_(pa.int32())) for x in (starts, ends)),
                ],
                names=[x.split()[0] for x in SCANNED.split(", ")],
            )


def secret_spans(docs: DataFrame, p: SecretScan = SecretScan(), models: MarkovPairs | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random, starts, ends) for each row of docs(doc_id, text, ...).

    spans lists kind:start:end in characters, end exclusive, by start and then
    kind; base_sha256 is the digest of those of the fixed patterns alone.  models
    default to those trained from `default_samples`.  Null and empty texts
    hold nothing.  Repeated rows and null ids are scanned like any other row;
    other columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(partial(_scan, p=p, models=models or default_models(p)), SCANNED)


def _redact(batches: Iterator[pa.RecordBatch], p: SecretScan, models: MarkovPairs, mask: str) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        column = batch.column("text")
        scanned = pa.Table.from_batches(list(_scan(iter([batch.select(["doc_id", "text"])]), p, models))) if batch.num_rows else None
        texts = column.to_pylist()
        if scanned is not None:
            found = zip(scanned["starts"].to_pylist(), scanned["ends"].to_pylist(), strict=True)
            for i, (starts, ends) in enumerate(found):
                if starts:
                    parts, done = [], 0
                    for a, b in sorted(zip(starts, ends, strict=True)):
                        if a >= done:
                            parts += [texts[i][done:a], mask]
                        done = max(done, b)
                    texts[i] = "".join(parts) + texts[i][done:]
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, column.type))


def redacted(docs: DataFrame, p: SecretScan = SecretScan(), models: MarkovPairs | None = None, mask: str = "[SECRET]") -> DataFrame:
    """docs with every span, overlapping ones as one, replaced by the mask; all rows and columns stay.

    Where there is a column n_chars it becomes the length of the new text; a null
    text stays null and keeps its n_chars.
    """
    out = docs.mapInArrow(partial(_redact, p=p, models=models or default_models(p), mask=mask), docs.schema)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out
