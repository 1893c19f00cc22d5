"""Source listings and metadata records. Resolving a listing over the network is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import first_truthy
from ..schemas import METADATA

# The page of a recording, and the encoder of each output format.
URL_PREFIX = "https://www.youtube.com/watch?v="
CODECS = {"wav": "pcm_s16le", "flac": "flac", "mp3": "libmp3lame"}


def entries(listing: DataFrame, max_items: int | None = None, order: str = "position") -> DataFrame:
    """The listing's entries in order: the limit comes first, then entries without an id are dropped."""
    rows = listing.orderBy(order) if max_items is not None else listing
    rows = rows if max_items is None else rows.limit(max_items)
    return rows.where(F.coalesce("id", F.lit("")) != "")


def entry_url(webpage_url: Column, url: Column, id: Column) -> Column:
    return first_truthy(webpage_url, url, F.concat(F.lit(URL_PREFIX), id))


def metadata(info: DataFrame) -> DataFrame:
    """The fixed columns of a metadata record, typed; missing ones null, others dropped."""
    have = set(info.columns)
    return info.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(METADATA).fields])


def mode(audio_only: Column) -> Column:
    return F.when(audio_only, F.lit("audio")).otherwise(F.lit("video"))


def format_selector(audio_only: Column, quality: Column) -> Column:
    video = F.format_string("bestvideo[height<=%s]+bestaudio/best[height<=%s]", quality, quality)
    return F.when(audio_only & quality.isin("lowest", "worst"), F.lit("worstaudio/worst")).when(audio_only, F.lit("bestaudio/best")).otherwise(video)


def output_path(requested: Column, folder: Column, id: Column, ext: Column) -> Column:
    """The path of the first requested download, else folder/id.ext."""
    return F.coalesce(F.try_element_at(requested, F.lit(1)), F.concat(folder, F.lit("/"), id, F.lit("."), ext))


def codec(fmt: Column) -> Column:
    found = F.element_at(F.create_map(*[F.lit(x) for kv in CODECS.items() for x in kv]), F.lower(fmt))
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("unsupported audio format: "), F.coalesce(fmt, F.lit("null"))))).otherwise(found)
