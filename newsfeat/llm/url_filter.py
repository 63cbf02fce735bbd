"""URL verdicts: rules by host and path, else logistic regression on hashed
character n-grams of host and path.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 14
HOST_SIZES = (3, 4, 5)
PATH_SIZES = (3, 4)
RIDGE = 0.001

#: Action, host and path of each rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: The labelled URL table: names of sites to block, and to allow, none of them
#: a site of the test tables.  Each stands in a URL for every pair of a prefix
#: and a top-level domain, so that these tell nothing about the label.
BLOCKED_NAMES = """
casino-royal best-casino online-casino casino-slots poker-win sport-bets bets-online betting-tips win-jackpot
pills-online cheap-viagra cheap-meds discount-pills pharma-deals cheap-watches replica-watches adult-video adult-chat
xxx-video hot-xxx sex-chat porn-tube free-porn ads-server track-clicks pixel-track click-ads banner-ads popup-ads
adserver link-farm spam-links spam-blog content-farm seo-spam free-money easy-money quick-loans payday-loans free-gift
win-prize free-ringtones crack-warez warez-download free-keygen hacked-accounts slot-machines online-poker
bingo-bonus gamble-now lucky-jackpot viagra-online cheap-pharmacy pills-shop diet-pills cheap-loans instant-loans
cash-advance earn-money make-money-fast free-prizes live-sex sex-cams hot-girls xxx-tube porn-free adult-tube
ad-tracker ad-clicks pixel-ads popup-clicks buy-backlinks cheap-links keygen-download crack-download hacked-passwords
""".split()
ALLOWED_NAMES = """
northern weather library museum therapist theatre attention station nation gardening recipes thornton heather
together mathematics history understand travel another others river mountain forest shelter bletchley university
science physics music painting kitchen council hospital school teachers stories bicycle football chess lighthouse
archive gazette harbour theresa edition reston thorne thehill ingrid andover heatherly attire orator old-mill
new-bridge st-andrews city-council green-garden poetry novels opera ballet chemistry economics geography pottery
knitting camping cycling rowing tennis cricket hockey airport railway market village castle abbey gallery cinema radio
newspaper daily-post evening-news town-hall fire-brigade book-club farmers-market garden-centre national-park
royal-society public-library high-school art-school film-festival
""".split()
PREFIXES = ("", "www.", "blog.", "m.")
TOP_DOMAINS = ("com", "org", "net")
PATHS = ("/en/12", "/de/345.html", "/fr/6/", "/es/789", "/", "/about")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], what: int | None) -> Column:
    """The longest rule that fits (``what`` None), or its action; null if none
    does.  A rule fits its host and all subdomains, if the path starts with
    its own; of rules of one length the first wins."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(rule[1] + rule[2] if what is None else rule[what])).otherwise(out)
    return out


def _grams(text: Column, sizes: Sequence[int], mark: str) -> Column:
    """Distinct character n-grams, marked by where they come from."""
    parts = [F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))),
                         lambda i, n=n: F.concat(F.lit(mark), text.substr(i, F.lit(n)))) for n in sizes]
    return F.array_distinct(F.concat(*parts))


def grams_of(host: Column, path: Column) -> Column:
    return F.concat(_grams(F.concat(F.lit("^"), host, F.lit("$")), HOST_SIZES, "h"),
                    _grams(F.concat(path, F.lit("$")), PATH_SIZES, "p"))


@dataclass
class UrlModel:
    hashing: HashingTF
    regression: LogisticRegressionModel


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(name, url, label)``: the small table above; 1 is to be blocked."""
    names = [(n, 1) for n in BLOCKED_NAMES] + [(n, 0) for n in ALLOWED_NAMES]
    rows = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{n}', {y}.0D)" for n, y in names) + " AS t(name, label)")
    listed = lambda values: F.explode(F.array(*map(F.lit, values)))
    rows = rows.withColumn("prefix", listed(PREFIXES)).withColumn("top", listed(TOP_DOMAINS))
    path = F.element_at(F.array(*map(F.lit, PATHS)), F.pmod(F.xxhash64("name", "prefix", "top"), F.lit(len(PATHS))).cast("int") + 1)
    url = F.concat(F.lit("http://"), F.col("prefix"), F.col("name"), F.lit(".example."), F.col("top"), path)
    return rows.select("name", url.alias("url"), "label")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> UrlModel:
    """Trained on a small table of URLs; rows with a null label are left out."""
    url = F.col(url_col)
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        grams_of(host_of(url), path_of(url)).alias("grams"), F.col(label_col).cast("double").alias("label"))
    hashing = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features")
    regression = LogisticRegression(regParam=RIDGE, maxIter=60, standardization=False)
    return UrlModel(hashing, regression.fit(hashing.transform(rows.coalesce(1))))


def judged(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
           url_col: str = "url") -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)``, a row for each row of
    ``pages``, without a shuffle: the rule's verdict or else the model's, which
    blocks if blocking is likelier than not; ``score`` is its probability.
    Defined results: a null url and one without ``://`` have an empty host and
    path, are fitted by no rule and left to the model; ids, null or repeated,
    are passed through; an empty table gives no rows; other columns are not
    read."""
    one = pages.select(F.col(id_col).alias("_page"), F.col(url_col).cast("string").alias("url"))
    one = one.select("_page", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    one = one.withColumn("grams", grams_of(F.col("host"), F.col("path")))
    scored = model.regression.transform(model.hashing.transform(one))
    host, path = F.col("host"), F.col("path")
    mine = F.when(F.col("prediction") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("_page").alias(id_col), "host", "path", rule_of(host, path, rules, None).alias("rule"),
                         F.coalesce(rule_of(host, path, rules, 0), mine).alias("verdict"),
                         vector_to_array("probability")[1].alias("score"))
