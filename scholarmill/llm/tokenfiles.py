"""Token ids as flat files: unsigned integers of one width, and 64-bit document offsets.

Documents are dealt into ranges of their id and sorted within them; each task encodes its range and writes three files
into the shared folder: the ids one after the other, the offsets of its documents, and the documents' own ids. Every
attempt of a task writes under a name of its own and reports it, so the manifest names one complete attempt of each
task whatever happens to executors. The bases of the files are prefix sums over the manifest; readers map the files
into memory and add the base.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmill.llm.automata import runs
from scholarmill.llm.rows import blocks, texts, words_between
from scholarmill.session import fresh_path, write_once

BLOCK_CHARS = 6_000_000

#: Parts of words whose ids a worker keeps from one block to the next.
LEXICON_PARTS = 1_000_000

#: Stands for a null document id in the file of ids.
NO_ID = -(1 << 63)

#: Signs that are cut off the ends of a word; the apostrophe joins letters, and <| |> may be a special token.
SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"

#: Letters that have one lower-case letter each and no combining forms.
LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

#: Parts of words that are given to the tokenizer as one text.
TOGETHER = 256

#: White space that separates words for the tokenizer under any reading; words may hold other white space.
GAPS = np.isin(np.arange(256), list(b" \n\t\r"))

#: How a tokenizer's file must normalise and split for its words to be encoded one by one (fixed values).
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def splits_at_white_space(path: str) -> bool:
    """Whether the tokenizer's file says that no token, added ones included, spans white space or depends on what is beyond it."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    added = [t for t in said.get("added_tokens") or [] if any(t.get(k) for k in ("lstrip", "rstrip", "single_word", "normalized"))
             or not re.fullmatch(r"<\|\w+\|>", t["content"])]
    return (said.get("normalizer") == WORD_NORMALIZER and said.get("pre_tokenizer") == WORD_SPLITTER and not added
            and not said.get("post_processor") and said["model"].get("type") == "BPE" and not said["model"].get("dropout"))


def parts(word: str) -> tuple[str, ...]:
    """Signs, lower-cased letters and signs, if that is what a word is; else the word itself."""
    core = word.strip(SIGNS)
    if not (core.isalpha() if core.isascii() else LETTERS.fullmatch(core)):
        return (word,)
    at = word.find(core)
    return word[:at], core.lower(), word[at + len(core):]


class Encoder:
    """Ids of whole texts, each distinct word encoded once.

    A tokenizer of the kind above drops white space and splits letters from signs before any merge, and its normaliser
    works within words and lower-cases. So a text's ids are those of its words one after the other, and a plain word with
    signs around it has the ids of the signs, of the lower-cased word, and of the signs. Words are told apart as Arrow
    dictionaries and their ids put in place by numpy, so Python sees distinct words only. The texts of any other
    tokenizer are encoded whole.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype(f"<u{width}")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.by_words = splits_at_white_space(path)
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[bytes, bytes] = {}

    def encode(self, texts_: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts_, add_special_tokens=False)

    def learn(self, new: list[str]) -> None:
        """Files the ids of new parts.

        Letters alone are one word to the tokenizer, so many go as one text, whose word ends tell them apart.
        """
        plain = [p for p in new if p.isalpha() and (p.isascii() or LETTERS.fullmatch(p))]
        known, size = self.known, self.kind.itemsize
        for at in range(0, len(plain), 64 * TOGETHER):
            groups = [plain[i:i + TOGETHER] for i in range(at, min(len(plain), at + 64 * TOGETHER), TOGETHER)]
            for group, found in zip(groups, self.encode([" ".join(g) for g in groups])):
                ids = np.array(found.ids, dtype=self.kind)
                stops = np.flatnonzero(self.ends_word[ids]) + 1
                if len(stops) != len(group) or (len(ids) and stops[-1] != len(ids)):
                    continue  # no word ends to go by: one by one below
                flat, stops = ids.tobytes(), (stops * size).tolist()
                known.update(zip(group, (flat[a:b] for a, b in zip([0, *stops], stops))))
        other = [p for p in new if p not in known]
        for at in range(0, len(other), 4096):
            some = other[at:at + 4096]
            known.update(zip(some, (np.array(found.ids, dtype=self.kind).tobytes() for found in self.encode(some))))

    def spelled(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.words) + len(self.known) > LEXICON_PARTS:
            self.words, self.known = {}, {"": b""}
        known = self.words
        out = list(map(known.get, words))
        new = [w for w, ids in zip(words, out) if ids is None]
        cut = [parts(w.decode("utf-8", "surrogatepass")) for w in new]
        self.learn([p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self.known])
        for w, own in zip(new, cut):
            known[w] = b"".join(map(self.known.__getitem__, own))
        return list(map(known.__getitem__, words)) if new else out

    def block(self, held: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)``: the ids of all texts, each with the end id after it, and how many each has."""
        if self.by_words:
            raw = [text.encode("utf-8", "surrogatepass") for text in held]
            words, start = words_between(np.frombuffer(b"\n".join(raw), dtype=np.uint8), GAPS)
            coded = words.dictionary_encode()
            spelled = self.spelled(coded.dictionary.to_pylist())
            length = np.array([len(x) for x in spelled], dtype=np.int64) // self.kind.itemsize
            begin, word = np.cumsum(length) - length, coded.indices.to_numpy()
            found = np.frombuffer(b"".join(spelled), dtype=self.kind)[runs(begin[word], length[word])]
            text_begin = np.append(0, np.cumsum([len(r) + 1 for r in raw]))[:-1]
            text = np.searchsorted(text_begin, start, side="right") - 1
            sizes = np.bincount(text, weights=length[word], minlength=len(held)).astype(np.int64) + 1
        else:
            whole = [np.array(x.ids, dtype=self.kind) for x in self.encode(held)]
            found, sizes = np.concatenate(whole), np.array([len(x) + 1 for x in whole], dtype=np.int64)
        ends = np.cumsum(sizes) - 1
        out = np.empty(int(sizes.sum()), dtype=self.kind)
        own = np.ones(len(out), dtype=bool)
        own[ends] = False
        out[own], out[ends] = found, end_id
        return out, sizes


@lru_cache(maxsize=2)
def encoder(path: str, width: int) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, width)


def write(docs: DataFrame, path: str, end_id: int, largest_id: int = 65_535, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The manifest ``(part, folder, name, width, n_docs, n_tokens, base)`` of files written in ascending id order.

    ``end_id`` follows each document. Ids take two bytes if ``largest_id`` allows, else four. A null or empty text is the
    end id alone; repeated rows stay, equal ids in order of their texts; null ids come first. Document ids are integers.
    No documents give no files.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    folder = fresh_path(spark, "token-files")
    width = 2 if max(largest_id, end_id) < 1 << 16 else 4
    schema = pa.schema([("part", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        own, store, at = None, None, ""
        offsets, keys = [np.zeros(1, dtype="<i8")], []
        total = 0
        part = TaskContext.get().partitionId()
        for ids, held in blocks(batches, BLOCK_CHARS):
            if store is None:
                own = encoder(path, width)
                store, place = pafs.FileSystem.from_uri(folder)
                store.create_dir(place, recursive=True)
                at = f"part-{part:06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(f"{place}/{at}.bin")
            encoded, sizes = own.block(held, end_id)
            out.write(encoded.tobytes())
            offsets.append(total + np.cumsum(sizes))
            total += int(sizes.sum())
            keys.append(np.array([NO_ID if k is None else k for k in ids], dtype="<i8"))
        if store is not None:
            out.close()
            for suffix, held in (("idx", offsets), ("doc", keys)):
                with store.open_output_stream(f"{place}/{at}.{suffix}") as out:
                    out.write(np.concatenate(held).astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": [part], "name": [at], "n_docs": [sum(map(len, keys))], "n_tokens": [total]}, schema=schema)

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = write_once(ordered.mapInArrow(run, "part bigint, name string, n_docs bigint, n_tokens bigint"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written.select("part", F.lit(folder).alias("folder"), "name", F.lit(width).alias("width"), "n_docs", "n_tokens",
                          F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("base"))


def mapped(store: pafs.FileSystem, place: str, kind: str) -> np.ndarray:
    """The numbers of a file, mapped into memory where the store is a file system of the machine."""
    if store.get_file_info(place).size == 0:
        return np.zeros(0, dtype=kind)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(place, dtype=kind, mode="r")
    with store.open_input_file(place) as file:
        return np.frombuffer(file.read_buffer(), dtype=kind)


def read(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` from the files; ``ids`` are little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        for batch in batches:
            for folder, name, width, base in zip(*(batch.column(i).to_pylist() for i in range(4))):
                store, place = pafs.FileSystem.from_uri(folder)
                ids = mapped(store, f"{place}/{name}.bin", f"<u{width}")
                offsets = mapped(store, f"{place}/{name}.idx", "<i8")
                keys = mapped(store, f"{place}/{name}.doc", "<i8")
                at = 0
                while at < len(keys):
                    # as many documents as make about a million ids
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 1_000_000)) - 1)
                    stop = min(stop, len(keys))
                    cut = offsets[at:stop + 1]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": [None if k == NO_ID else k for k in keys[at:stop].tolist()],
                        "start": base + cut[:-1], "n_tokens": cut[1:] - cut[:-1],
                        "ids": [ids[a:b].astype("<u4").tobytes() for a, b in zip(cut.tolist(), cut[1:].tolist())]}, schema=schema)
                    at = stop

    # a number of partitions that is asked for stays: the manifest's few rows stand for all ids
    files = manifest.select("folder", "name", "width", "base", "part").repartition(max(1, manifest.count()), "part").drop("part")
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def digests(read_back: DataFrame) -> DataFrame:
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
