"""Input resolution: web addresses, manifests, media files and their audio streams, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.functions.keys import slugify
from voxlake.functions.text import normalize_language

# What counts as media, and how a title marks a track that isn't the main one.
MEDIA_EXTENSIONS = (
    "mp4", "mkv", "webm", "avi", "mov", "m4v", "flv", "wmv", "mpg", "mpeg", "ts", "m2ts", "3gp",
    "mp3", "wav", "flac", "m4a", "aac", "ogg", "oga", "opus", "wma", "aiff", "aif", "mka", "ac3",
)
PREFERRED_LANGUAGES = ("eng", "en")
SKIPPED_TITLES = ("commentary", "description", "descriptive")
_ID = "[A-Za-z0-9_-]{11}"


def is_url(text: Column) -> Column:
    return text.rlike("^https?://")


def _host(url: Column) -> Column:
    host = F.regexp_extract(F.lower(url), "^[a-z]+://([^/?#:]*)", 1)
    return F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"^m\.", "")


def _path(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://[^/?#]*([^?#]*)", 1)


def youtube_video_id(url: Column) -> Column:
    """The id in the address forms of that site (subdomains of it only), or null."""
    host, path = _host(url), _path(url)
    short = F.regexp_extract(url, f"^[a-z]+://[^/]*/+({_ID})(?:[/?#]|$)", 1)
    watch = F.regexp_extract(url, f"[?&]v=({_ID})(?:[&#]|$)", 1)
    other = F.regexp_extract(path, f"^/[a-z]+/({_ID})(?:/|$)", 1)
    site = (host == "youtube.com") | host.endswith(".youtube.com")
    found = F.when(host == "youtu.be", short).when(site & (path == "/watch"), watch).when(site & path.rlike("^/(shorts|live|embed)/"), other)
    return F.nullif(found, F.lit(""))


def looks_like_playlist(url: Column) -> Column:
    path = _path(url)
    listed = url.rlike("[?&]list=") & youtube_video_id(url).isNull()
    return F.contains(_host(url), F.lit("youtube.com")) & ((path == "/playlist") | path.rlike("^/(@|channel/|c/|user/)") | listed)


def url_source_id(url: Column) -> Column:
    """The id of a web source: that of the video, or a hash of the address as a JSON string."""
    hashed = F.concat(F.lit("url-"), F.substring(F.sha1(F.concat(F.lit('"'), url, F.lit('"'))), 1, 12))
    return F.coalesce(F.concat(F.lit("yt-"), youtube_video_id(url)), hashed)


def canonical_url(url: Column) -> Column:
    return F.coalesce(F.concat(F.lit("https://www.youtube.com/watch?v="), youtube_video_id(url)), url)


def manifest_uri(uri: Column, base: Column) -> Column:
    """Relative paths resolved against the manifest's folder."""
    u = F.trim(uri)
    return F.when(is_url(u) | u.startswith("/"), u).otherwise(F.concat(base, F.lit("/"), u))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """pos, uri, language of a .jsonl, .csv, .tsv or list manifest. In lists a last token of letters, up to 8 long, is a language; # starts a comment."""
    base = F.lit(path.rsplit("/", 1)[0])
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "jsonl":
        rows = spark.read.schema("uri string, language string").json(path)
    elif kind in ("csv", "tsv"):
        rows = spark.read.option("header", True).option("sep", "\t" if kind == "tsv" else ",").csv(path)
        rows = rows.select("uri", rows["language"] if "language" in rows.columns else F.lit(None).cast("string").alias("language"))
    else:
        lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' AND NOT startswith(v, '#')")
        last = F.regexp_extract("v", r"^.*\S\s+([A-Za-z][A-Za-z_-]{0,7})$", 1)
        rows = lines.select(F.when(last != "", F.regexp_replace("v", r"\s+\S+$", "")).otherwise(F.col("v")).alias("uri"), F.nullif(last, F.lit("")).alias("language"))
    return rows.select(F.monotonically_increasing_id().alias("pos"), manifest_uri(F.col("uri"), base).alias("uri"), F.nullif("language", F.lit("")).alias("language"))


def scan_media(spark: SparkSession, folder: str) -> DataFrame:
    """path, length of the media files below a folder; names that start with a dot are left out. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*MEDIA_EXTENSIONS) & ~name.startswith("."))


def local_source_id(path: Column, fingerprint: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    slug = slugify(stem)
    return F.concat(F.when(slug == "", "file").otherwise(slug), F.lit("-"), F.substring(fingerprint, 1, 10))


def fingerprint(content: Column, length: Column) -> Column:
    """SHA-1 of the size, the first 4 MiB and, beyond 8 MiB, the last 4 MiB."""
    part = 4 << 20
    tail = F.when(length > 2 * part, F.substring(content, -part, part)).otherwise(F.lit(b""))
    return F.sha1(F.concat(F.encode(length.cast("string"), "utf-8"), F.substring(content, 1, part), tail))


def resolve(inputs: DataFrame, default_language: str | None = None) -> DataFrame:
    """Web sources of inputs (pos, uri, language): the first of each id stays, by pos; its own language before the default."""
    s = inputs.where(is_url(F.col("uri"))).select("pos", url_source_id(F.col("uri")).alias("source_id"), canonical_url(F.col("uri")).alias("uri"), F.lit("url").alias("kind"), F.coalesce(normalize_language(F.col("language")), normalize_language(F.lit(default_language))).alias("language"))
    first = F.row_number().over(Window.partitionBy("source_id").orderBy("pos"))
    return s.withColumn("_n", first).where("_n = 1").select("source_id", "uri", "kind", "language").orderBy("source_id")


_PROBE = "streams array<struct<codec_type:string,codec_name:string,channels:int,channel_layout:string,sample_rate:string,tags:map<string,string>,disposition:map<string,int>>>"


def audio_streams(probes: DataFrame) -> DataFrame:
    """Audio streams, numbered from 0, of probes (source_id, probe as JSON)."""
    parsed = probes.select("source_id", F.from_json("probe", _PROBE)["streams"].alias("s"))
    audio = parsed.select("source_id", F.posexplode(F.filter("s", lambda x: x["codec_type"] == "audio")).alias("index", "s"))
    tags = F.transform_keys(F.coalesce("s.tags", F.create_map().cast("map<string,string>")), lambda k, _: F.lower(k))
    tag = lambda k: F.nullif(F.try_element_at(tags, F.lit(k)), F.lit(""))
    flag = lambda k: F.coalesce(F.try_element_at("s.disposition", F.lit(k)) != 0, F.lit(False))
    return audio.select(
        "source_id", "index", F.col("s.codec_name").alias("codec"), F.coalesce("s.channels", F.lit(0)).alias("channels"), "s.channel_layout", F.expr("try_cast(s.sample_rate AS INT)").alias("sample_rate"),
        F.lower(tag("language")).alias("language"), F.coalesce(tag("title"), tag("handler_name")).alias("title"), flag("default").alias("is_default"), flag("comment").alias("is_commentary"), flag("visual_impaired").alias("is_audio_description"),
    )


def select_streams(streams: DataFrame, languages: tuple[str, ...] = PREFERRED_LANGUAGES, skipped: tuple[str, ...] = SKIPPED_TITLES, index: int | None = None) -> DataFrame:
    """The main dialogue stream of each source: commentary and description last, then by language, default mark, channels, number.
    With ``index`` that stream, and a failure for a source that lacks it."""
    if index is not None:
        there = F.max(F.col("index") == index).over(Window.partitionBy("source_id"))
        message = F.concat(F.lit(f"no audio stream {index} in "), F.col("source_id").cast("string"))
        return streams.withColumn("_there", there).where(F.when(F.col("_there"), F.col("index") == index).otherwise(F.raise_error(message).cast("boolean"))).drop("_there")
    title = F.lower(F.coalesce("title", F.lit("")))
    excluded = F.col("is_commentary") | F.col("is_audio_description")
    for k in skipped:
        excluded = excluded | F.contains(title, F.lit(k))
    place = F.array_position(F.array(*(F.lit(x) for x in languages)), F.coalesce("language", F.lit("")))
    order = [excluded.cast("int"), F.when(place == 0, len(languages) + 1).otherwise(place), (~F.col("is_default")).cast("int"), -F.col("channels"), F.col("index")]
    return streams.withColumn("_n", F.row_number().over(Window.partitionBy("source_id").orderBy(*order))).where("_n = 1").drop("_n")
