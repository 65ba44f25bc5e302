"""Token ids of texts by the vocabulary file of a public tokenizer, whose path is a parameter."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encoder(path: str):
    """Encodes lists of texts with a ``tokenizers`` JSON file or a sentencepiece model; needs the library."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: p.encode(texts, num_threads=1)


_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def merged_pieces(pieces: Sequence[str]) -> list[str]:
    """Pieces without byte fallback: byte pieces in a row are joined as soon as their bytes are characters; what never is stays as it is."""
    out: list[str] = []
    held: list[str] = []
    for p in [*pieces, None]:
        byte = _BYTE.fullmatch(p) if p is not None else None
        if byte:
            held.append(byte[1])
            try:
                out.append(bytes.fromhex("".join(held)).decode())
                held.clear()
            except UnicodeDecodeError:
                pass
            continue
        if held:
            out.append("".join(f"<0x{h}>" for h in held))
            held.clear()
        if p is not None:
            out.append(p)
    return out


def token_pieces(text: Column, path: str) -> Column:
    """Pieces of a text by a sentencepiece model, without byte fallback, in Arrow batches; null for null."""
    cache: dict = {}

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        if path not in cache:
            import sentencepiece

            cache[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        return texts.map(lambda t: merged_pieces(cache[path].encode(t, out_type=str)), na_action="ignore")

    return run(text)


def token_ids(text: Column, path: str, newline: int | None = None, begin: int | None = None) -> Column:
    """Ids of a text in Arrow batches; null for null. With ``newline`` lines are encoded alone and joined by that id; ``begin`` comes first.

    The file is read once by each Python worker, so it must be where the executors find it.
    """
    cache: dict = {}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pd.Series) -> pd.Series:
        encode = cache.get(path) or cache.setdefault(path, encoder(path))
        lines = [t.split("\n") if newline is not None else [t] for t in texts.fillna("")]
        ids = iter(encode([x for ls in lines for x in ls]))
        out = []
        for missing, ls in zip(texts.isna(), lines):
            row = [] if begin is None else [begin]
            for k in range(len(ls)):
                row += ([newline] if k else []) + list(next(ids))
            out.append(None if missing else row)
        return pd.Series(out)

    return run(text)
