"""Models as plug-ins: what an extractor, an embedder and a scorer must do, and deterministic stand-ins."""

from __future__ import annotations

import json
import urllib.request
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The types of entities, what may be asserted of a mention, and the types of which it may.
ENTITY_TYPES = ["TRIỆU_CHỨNG", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM", "CHẨN_ĐOÁN", "THUỐC"]
ASSERTIONS = ["isNegated", "isFamily", "isHistorical"]
TYPES_WITH_ASSERTIONS = ["CHẨN_ĐOÁN", "THUỐC", "TRIỆU_CHỨNG"]
ENTITY_CAP = 100

RESULT = "struct<ok:boolean,error:string,entities:array<struct<text:string,type:string,assertions:array<string>>>>"


#: What an extractor is asked for: our own wording of the contract that alignment and linking rely on.
INSTRUCTIONS = """You mark mentions of clinical entities in a Vietnamese text. Answer with one JSON object {"entities": [...]}; each
entity has text, type and assertions.
1. Copy text letter by letter from the input: no spelling mistake is mended, nothing is translated, completed or put in order.
2. Take the shortest span that names the entity. Leave out degree, duration, time, place of care and verbs; a drug keeps its
strength, form and route.
3. The type is the first that fits: THUỐC for a drug that is given or taken; TÊN_XÉT_NGHIỆM for a test that is named;
KẾT_QUẢ_XÉT_NGHIỆM for the value that a test gave; CHẨN_ĐOÁN for a disease that a clinician names as such; TRIỆU_CHỨNG for what
a patient feels or an examiner sees.
4. List mentions in the order of the text, each as often as it occurs.
5. assertions belong to the one mention: isNegated where the text denies it, isFamily where a relative has it, isHistorical
where it lies before this illness. Only diagnoses, drugs and symptoms have them; else the list is empty.
6. Never answer with an entity that the text does not hold; an empty list is a right answer."""


def answer_schema(cap: int = ENTITY_CAP) -> dict:
    """The JSON schema of an answer: a closed set of types and assertions, and a bounded list."""
    entity = {
        "type": "object", "additionalProperties": False, "required": ["text", "type", "assertions"],
        "properties": {
            "text": {"type": "string", "minLength": 1}, "type": {"type": "string", "enum": ENTITY_TYPES},
            "assertions": {"type": "array", "items": {"type": "string", "enum": ASSERTIONS}, "maxItems": len(ASSERTIONS)},
        },
    }
    entities = {"type": "array", "maxItems": cap, "items": entity}
    return {"type": "object", "additionalProperties": False, "required": ["entities"], "properties": {"entities": entities}}


def build_prompt(instructions: str, text: str) -> list[dict]:
    if not instructions.strip():
        raise ValueError("the prompt is empty")
    return [{"role": "system", "content": instructions}, {"role": "user", "content": text}]


def checked_entities(entities: list[dict]) -> list[dict]:
    """Fails on too many entities, unknown types or assertions; nothing is cut silently."""
    if len(entities) > ENTITY_CAP:
        raise ValueError(f"{len(entities)} entities; at most {ENTITY_CAP} are allowed")
    for e in entities:
        if e.get("type") not in ENTITY_TYPES:
            raise ValueError(f"no entity type {e.get('type')!r}")
        if bad := [a for a in e.get("assertions") or [] if a not in ASSERTIONS]:
            raise ValueError(f"no assertions {bad}")
    return [{"text": e.get("text") or "", "type": e["type"], "assertions": list(e.get("assertions") or [])} for e in entities]


def endpoint_extractor(url: str, model: str, instructions: str = INSTRUCTIONS, max_tokens: int = 3072, timeout: float = 600.0) -> Callable[[str], list[dict]]:
    """An extractor behind an OpenAI-compatible chat endpoint, which is held to answer_schema()."""

    def extract(text: str) -> list[dict]:
        body = {"model": model, "temperature": 0, "max_tokens": max_tokens, "messages": build_prompt(instructions, text), "response_format": {"type": "json_schema", "json_schema": {"name": "entities", "strict": True, "schema": answer_schema()}}}
        request = urllib.request.Request(f"{url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.loads(json.load(answer)["choices"][0]["message"]["content"])["entities"]

    return extract


def preflight(extract: Callable[[str], list[dict]], probe: str = "ping") -> None:
    """One call on the driver before a job starts; its failure is the job's."""
    extract(probe)


#: What workers have loaded, by name: a model is loaded once a worker process, not once a task or batch.
LOADED: dict[str, object] = {}


def loaded(name: str, load: Callable[[], object]) -> object:
    if name not in LOADED:
        LOADED[name] = load()
    return LOADED[name]


def extract_entities(docs: DataFrame, extract: Callable[[str], list[dict]] | None = None, text_col: str = "text", load: tuple[str, Callable[[], Callable]] | None = None) -> DataFrame:
    """Adds result (ok, error, entities); a failing document does not fail the others. The extractor is given as it is,
    or as a name and a function that loads it in the worker."""

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        extract_one = loaded(*load) if load else extract
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    rows.append((True, None, checked_entities(extract_one(t or ""))))
                except Exception as e:  # noqa: BLE001  any failure of a model is the document's error
                    rows.append((False, f"{type(e).__name__}: {e}", None))
            yield pd.DataFrame(rows, columns=["ok", "error", "entities"])

    return docs.withColumn("result", run(F.col(text_col)))


def hashed_embedding(text: Column, dim: int = 64) -> Column:
    """A stand-in embedder: signed counts of hashed tokens, of unit length."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> np.ndarray:
            v = np.zeros(dim, np.float32)
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode())
                v[h % dim] += 1 if h >> 31 else -1
            n = float(np.linalg.norm(v))
            if n == 0:
                v[0] = n = 1.0
            return v / n

        return texts.map(one)

    return run(text)


def blended_scorer(pairs: DataFrame, lexical_weight: float = 1.0, dense_weight: float = 1.0) -> DataFrame:
    """A stand-in reranker: a weighted sum of the branch scores; rows keep their order columns."""
    part = lambda c, w: F.coalesce(F.col(c), F.lit(0.0)) * w
    return pairs.withColumn("rerank_score", part("bm25_score", lexical_weight) + part("dense_score", dense_weight))


def in_batches(values: list, size: int) -> Iterator[list]:
    return (values[at : at + size] for at in range(0, len(values), size))


def reranked(pairs: DataFrame, name: str, load: Callable[[], Callable[[str, list[tuple[str, str]]], list[float]]], instruction: str, batch: int = 8, query: str = "query", text: str = "text", score: str = "rerank_score") -> DataFrame:
    """Adds score, a raw number for each (query, text). load gives a scorer (instruction, pairs) -> scores in the order of
    the pairs; it runs once a worker. The instruction is part of the model's calibration and never varies within a run."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = loaded(name, load)
        for queries, texts in batches:
            rows = list(zip(queries.fillna(""), texts.fillna(""), strict=True))
            scores = [float(s) for part in in_batches(rows, batch) for s in scorer(instruction, part)]
            if len(scores) != len(rows):
                raise ValueError(f"{len(scores)} scores for {len(rows)} pairs")
            yield pd.Series(scores, dtype="float64")

    return pairs.withColumn(score, run(F.col(query), F.col(text)))


def as_scorer(name: str, load: Callable[[], Callable[[str, list[tuple[str, str]]], list[float]]], instruction: str, batch: int = 8) -> Callable[[DataFrame], DataFrame]:
    """A reranker as linking takes it: pairs with query and text get a rerank_score."""
    return lambda pairs: reranked(pairs, name, load, instruction, batch)


def prompted_embedding(name: str, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 64) -> Callable[[Column, str], Column]:
    """An embedder as a function (text, prompt) to a column of unit vectors. load gives an encoder of a list of texts, run
    once a worker; queries and documents have prompts of their own, which are put before their texts."""

    def embed(text: Column, prompt: str) -> Column:
        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = loaded(name, load)
            for texts in batches:
                rows = [prompt + (t or "") for t in texts]
                found = [np.asarray(v, np.float32) for part in in_batches(rows, batch) for v in encode(part)]
                yield pd.Series([v / max(float(np.linalg.norm(v)), 1e-12) for v in found])

        return run(text)

    return embed


def hashed_encoder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A stand-in encoder: signed counts of hashed tokens."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for row, t in zip(out, texts, strict=True):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                row[h % dim] += 1 if h >> 31 else -1
        return out

    return encode


def shared_words_scorer(instruction: str, pairs: list[tuple[str, str]]) -> list[float]:
    """A stand-in cross-encoder: the share of the query's distinct words that the text has."""
    words = [(set(q.lower().split()), set(t.lower().split())) for q, t in pairs]
    return [len(q & t) / max(1, len(q)) for q, t in words]
