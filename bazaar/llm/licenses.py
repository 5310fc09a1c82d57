"""License scans: TF-IDF cosine of texts to templates, and inheritance along directories.

All steps are SQL functions. Weights are whole numbers, so cosines do not depend on the order of
a sum.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stage
from bazaar.llm.license_templates import FILES, HEADERS

# A line or file carries a template's licence from this cosine on.
THRESHOLD = 0.75
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Names of files that speak for their directory.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([-._].*)?$"


def tokens_of(text: str) -> list[str]:
    return re.findall(TOKEN, text.translate(str.maketrans(UPPER, LOWER)))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TOKEN), 0)


@dataclass(frozen=True)
class Templates:
    """Templates of notices (matched line by line) and of whole files."""

    headers: tuple[tuple[str, str], ...] = tuple(HEADERS)
    files: tuple[tuple[str, str], ...] = tuple(FILES)

    def rows(self) -> list[tuple[int, str, bool, Counter]]:
        """Number, licence, whether it is a whole file's, and token counts of each template."""
        kinds = [(h, False) for h in self.headers] + [(f, True) for f in self.files]
        return [
            (i, licence, whole, Counter(tokens_of(text)))
            for i, ((licence, text), whole) in enumerate(kinds)
        ]

    def weights(self) -> dict[str, int]:
        """1000 idf of each token over the templates, as whole numbers."""
        rows = self.rows()
        df = Counter(token for *_, counts in rows for token in counts)
        return {token: round(1000 * math.log(1 + len(rows) / n)) for token, n in df.items()}

    def unknown(self) -> int:
        """The weight of a token that no template has: as much as one that a single one has."""
        return round(1000 * math.log(1 + len(self.rows())))

    def entries(self) -> dict[int, dict[str, int]]:
        """The weight of each token in each template: idf, times 1 + ln of its count there."""
        weights = self.weights()
        return {
            i: {t: round(weights[t] * (1 + math.log(n))) for t, n in counts.items()}
            for i, _, _, counts in self.rows()
        }

    def norms(self) -> dict[int, int]:
        """The square of each template's length."""
        return {i: sum(w * w for w in own.values()) for i, own in self.entries().items()}

    def anchors(self, threshold: float, whole: bool) -> list[str]:
        """Tokens of which every match with a notice (or a whole file's text) has one.

        What a template has besides them is too short for the threshold, whatever else a text
        holds (Cauchy-Schwarz). Long and rare tokens come first, which few other texts have.
        """
        idf, found = self.weights(), set()
        entries, norms = self.entries(), self.norms()
        for i, _, is_file, _ in self.rows():
            if is_file != whole:
                continue
            left = sum(w * w for t, w in entries[i].items() if t not in found)
            for token in sorted(entries[i], key=lambda t: (-len(t) * idf[t], t)):
                if left < threshold**2 * norms[i] * 0.999:
                    break
                if token not in found:
                    found.add(token)
                    left -= entries[i][token] ** 2
        return sorted(found)


DEFAULT_TEMPLATES = Templates()


def own_licenses(
    files: DataFrame, path: str, text: str, templates: Templates, threshold: float
) -> DataFrame:
    """``path``, ``hash`` (of the text), ``license`` and ``cosine`` of the files that carry a
    notice or are a licence's text: the best match, of equal ones the first licence by name."""
    spark = files.sparkSession
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    # Anchors leave files aside in one pass of an expression; few files have any.
    def anchored(column: str, *kinds: bool) -> Column:
        words = {t for whole in kinds for t in templates.anchors(threshold, whole)}
        pattern = "(?<![a-z0-9])(?:" + "|".join(map(re.escape, sorted(words))) + ")(?![a-z0-9])"
        return F.translate(column, UPPER, LOWER).rlike(pattern)

    texts = files.select(
        F.col(f"`{path}`").alias("path"), F.xxhash64(value).alias("hash"), value.alias("text")
    ).where(anchored("text", False, True))
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.lit(False).alias("whole"), line.alias("text"))
    )
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("text")))
    units = stage(
        texts.dropDuplicates(["path", "hash"])
        .select("path", "hash", F.explode(F.concat(lines, whole)).alias("part"))
        .where(
            F.when(F.col("part.whole"), anchored("part.text", True)).otherwise(
                anchored("part.text", False)
            )
        )
        .select(
            F.monotonically_increasing_id().alias("unit"), "path", "hash", "part.whole",
            tokens(F.col("part.text")).alias("tokens"),
        ),
        "licence-units",
    )
    key = ["unit", "whole"]
    counts = units.select(*key, F.explode("tokens").alias("token")).groupBy(*key, "token").agg(
        F.count("*").alias("n")
    )
    # Both tables are as large as the templates, which are code.
    weights, norms = templates.weights(), templates.norms()
    idf = spark.createDataFrame(list(weights.items()), "token string, idf long")
    entries = spark.createDataFrame(
        [
            (token, i, licence, is_file, weight, norms[i])
            for i, licence, is_file, _ in templates.rows()
            for token, weight in templates.entries()[i].items()
        ],
        "token string, template int, license string, is_file boolean, weight long, norm long",
    )
    weighed = counts.join(F.broadcast(idf), "token", "left").withColumn(
        "w",
        F.round(F.coalesce("idf", F.lit(templates.unknown())) * (1 + F.log(F.col("n")))).cast("long"),
    )
    length = weighed.groupBy(*key).agg(F.sum(F.col("w") * F.col("w")).alias("square"))
    dot = (
        weighed.join(F.broadcast(entries), "token")
        .where(F.col("whole") == F.col("is_file"))
        .groupBy(*key, "template", "license", "norm")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    cosine = F.col("dot").cast("double") / F.sqrt(F.col("square").cast("double") * F.col("norm"))
    return (
        dot.join(length, key)
        .withColumn("cosine", cosine)
        .where(F.col("cosine") >= threshold)
        .join(units.select("unit", "path", "hash"), "unit")
        .groupBy("path", "hash")
        .agg(F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("license"))).alias("best"))
        .select("path", "hash", "best.license", (-F.col("best.minus")).alias("cosine"))
    )


def directory(path: Column) -> Column:
    """The directory of a path, without its last part; '' for the top one."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Templates = DEFAULT_TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each file: ``path``, ``license``, ``cosine`` and ``basis``.

    A file's own licence is that of the template nearest to one of its lines (notices) or to the
    whole file (licence texts), by cosine of TF-IDF vectors; tokens that no template has count
    against it. ``basis`` is ``own`` then. A file whose name says that it is a licence file
    speaks for its directory, the best match first, then the first licence by name. A file
    without a licence of its own has that of its nearest ancestor directory (``inherited``, no
    cosine), or none at all.

    Whole texts are searched. A null or empty text carries no licence, a null path is in no
    directory; repeated rows each get the same result; an empty table gives an empty one.

    Files without any anchor are left by one expression in the scan; the others' tokens are
    summed by key. Inheritance works on distinct directories: their ancestors are joined to the
    directories that have a licence, and the nearest one is kept, before it meets the files.
    """
    own = own_licenses(files, path, text, templates, threshold)
    name = F.regexp_extract("path", r"[^/]*$", 0)
    spoken = (
        own.where(name.rlike(LICENCE_FILE))
        .groupBy(directory(F.col("path")).alias("above"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("license"))).alias("best"))
        .select("above", F.col("best.license").alias("given"))
    )
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    listed = files.select(F.col(f"`{path}`").alias("path"), F.xxhash64(value).alias("hash"))
    parts = F.split("folder", "/")
    # '' is an ancestor of all; a/b/c has the ancestors a, a/b and itself.
    ancestors = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")
    )
    nearest = (
        listed.where("path is not null").select(directory(F.col("path")).alias("folder")).distinct()
        .select("folder", F.explode(F.array_distinct(ancestors)).alias("above"))
        .join(spoken, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above"), F.col("given"))).alias("best"))
        .select(F.col("folder"), F.col("best.given").alias("inherited"))
    )
    own = own.select(
        F.col("path").alias("own_path"), F.col("hash").alias("own_hash"), "license", "cosine"
    )
    return (
        listed.join(
            own, F.col("path").eqNullSafe(F.col("own_path")) & (F.col("hash") == F.col("own_hash")), "left"
        )
        .withColumn("folder", directory(F.col("path")))
        .join(nearest, "folder", "left")
        .select(
            F.col("path").alias(path),
            F.coalesce("license", "inherited").alias("license"),
            "cosine",
            F.when(F.col("license").isNotNull(), "own")
            .when(F.col("inherited").isNotNull(), "inherited").alias("basis"),
        )
    )
