"""Tokenizer files (vocabulary + merges) read with Spark; small (vocabulary-sized) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import Tokenizer

# ---- fixed values (file format tag that must equal the reference's files) ---------------------
HEX_FORMAT = "cs336_bytes_hex_v1"
# ----------------------------------------------------------------------------------------------


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def _parsed(col: str, schema: str, path: str):
    """``from_json`` that fails on a file that does not parse."""
    return F.coalesce(F.from_json(col, schema), F.raise_error(F.lit(f"not a JSON map: {path}")).cast(schema))


def _two(parts):
    """The two tokens of a merge line; other numbers of tokens are an error."""
    return F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.lit("a merge line must hold exactly two tokens")))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``vocab(token_id INT, token BINARY)`` from hex JSON v1 or the legacy latin-1 JSON map."""
    raw = _whole(spark, path)
    fmt = F.get_json_object("value", "$.format")
    hex_map = F.from_json(F.get_json_object("value", "$.vocab"), "map<string,string>")
    legacy = _parsed("value", "map<string,string>", path)
    rows = raw.select(
        F.explode(F.when(fmt == HEX_FORMAT, hex_map).otherwise(legacy)).alias("k", "v"), (fmt == HEX_FORMAT).alias("is_hex")
    ).filter(F.col("k") != "format")
    return rows.select(
        F.col("k").cast("int").alias("token_id"),
        F.when(F.col("is_hex"), F.unhex("v")).otherwise(F.encode("v", "ISO-8859-1")).alias("token"),
    )


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """``merges(rank INT, left BINARY, right BINARY)`` from hex JSON v1 or legacy ``left right`` lines.

    The format is recognised from the content (the JSON format tag), not from the file name.

    A legacy line that does not split into exactly two parts (e.g., a merge holding a space) makes
    the read fail instead of being skipped silently.
    """
    raw = _whole(spark, path)
    fmt = raw.select(F.get_json_object("value", "$.format").alias("f")).first()
    if fmt is not None and fmt.f == HEX_FORMAT:
        arr = F.from_json(F.get_json_object("value", "$.merges"), "array<array<string>>")
        return raw.select(F.posexplode(arr).alias("rank", "m")).select(
            "rank", F.unhex(F.col("m")[0]).alias("left"), F.unhex(F.col("m")[1]).alias("right")
        )
    # Vocabulary-sized file, already read whole: lines get their rank from posexplode (file order).
    lines = raw.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n", -1)).alias("rank", "line"))
    parts = lines.filter(F.col("line") != "").select("rank", F.split("line", " ", -1).alias("p"))
    checked = parts.select("rank", _two(F.col("p")).alias("p"))
    return checked.select(
        F.col("rank").cast("int").alias("rank"),
        F.encode(F.col("p")[0], "ISO-8859-1").alias("left"),
        F.encode(F.col("p")[1], "ISO-8859-1").alias("right"),
    )


def load_tokenizer(spark: SparkSession, vocab_path: str, merges_path: str, specials=None) -> Tokenizer:
    """Build the driver-side Tokenizer (its size is the vocabulary's)."""
    return _tokenizer(read_vocab(spark, vocab_path), read_merges(spark, merges_path), specials)


# ---- fixed values: the byte ranges that stand for themselves in printable tokenizer files -----
PRINTABLE_RANGES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
# ----------------------------------------------------------------------------------------------


def printable_byte_map() -> dict[str, int]:
    """The printable stand-in character of every byte: itself, or in order the code points from 256 on."""
    own = [b for low, high in PRINTABLE_RANGES for b in range(low, high + 1)]
    others = sorted(set(range(256)) - set(own))
    return dict(zip(map(chr, [*own, *range(256, 256 + len(others))]), [*own, *others]))


def load_printable_tokenizer(spark: SparkSession, vocab_path: str, merges_path: str, specials=None) -> Tokenizer:
    """The driver-side Tokenizer of printable vocabulary and merge files."""
    return _tokenizer(read_printable_vocab(spark, vocab_path), read_printable_merges(spark, merges_path), specials)


def _tokenizer(vocab: DataFrame, merges: DataFrame, specials) -> Tokenizer:
    ids = {r.token_id: bytes(r.token) for r in vocab.collect()}
    ranked = sorted(merges.collect(), key=lambda r: r.rank)
    return Tokenizer(dict(sorted(ids.items())), [(bytes(r.left), bytes(r.right)) for r in ranked], list(specials or []))


def _printable_to_binary(col):
    """Printable string -> BINARY through the byte map (a 256-entry map literal)."""
    m = printable_byte_map()
    keys = list(m)
    hexmap = F.map_from_arrays(F.lit(keys), F.lit([f"{m[k]:02X}" for k in keys]))
    chars = F.split(col, "", -1)
    return F.unhex(F.array_join(F.transform(chars, lambda c: F.element_at(hexmap, c)), ""))


def read_printable_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``{printable_token: id}`` JSON -> ``vocab(token_id, token BINARY)``."""
    raw = _whole(spark, path).select(F.explode(_parsed("value", "map<string,int>", path)).alias("k", "token_id"))
    return raw.select("token_id", _printable_to_binary(F.col("k")).alias("token"))


def read_printable_merges(spark: SparkSession, path: str) -> DataFrame:
    """``left right`` lines in printable form -> ``merges(rank, left, right)`` (rank = line order)."""
    raw = _whole(spark, path)
    lines = raw.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n", -1)).alias("line_no", "line"))
    parts = lines.filter(F.col("line") != "").select("line_no", F.split("line", " ", -1).alias("p"))
    return parts.select("line_no", _two(F.col("p")).alias("p")).select(
        F.col("line_no").cast("int").alias("rank"),
        _printable_to_binary(F.col("p")[0]).alias("left"),
        _printable_to_binary(F.col("p")[1]).alias("right"),
    )
