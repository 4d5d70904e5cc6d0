"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

A rule is a host and the beginning of a path, allowed or blocked; it fits its host and all subdomains,
and the longest rule that fits decides. Other URLs are judged by a model trained from a small labelled
table of URLs, in numpy. The table is made of families of words, so that what is learned are parts of words:
a form of a family that the table lacks is told by what it shares with its sisters (tests leave forms out).

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged
by the model on empty strings; URLs are read whole; repeated rows are judged alike; of equal rules block
wins; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
BUCKETS, GRAMS, STEPS = 1 << 18, (3, 4, 5), 400
#: Added to the squared norm of a URL's n-grams, so that a short one is not told by a single n-gram.
SHORT = 200.0

# Words of which the labelled table is made: families of what is unwanted, and ordinary words.
UNWANTED = (
    ("casinos", "kasino", "casinoclub", "mycasinos"), ("betting", "bettor", "bet", "sportsbet", "betz"), ("poker", "pokers", "pokerroom"), ("slot", "slots", "slotz", "megaslots"),
    ("jackpot", "jackpots", "jackpotz"), ("roulette", "roulettes", "rouletten"), ("lottery", "lotto", "lottos", "lotteries"), ("gambling", "gamble", "gambler", "gambles"), ("wager", "wagers", "wagering"),
    ("winner", "winners", "winning", "wins", "bigwin", "winbig"), ("prizes", "prize", "prizez"), ("bonus", "bonuses", "bonusz"), ("freebie", "freebies", "freez", "freely", "forfree"),
    ("cheaper", "cheapest", "cheapo", "cheaply"), ("discounts", "discount", "discounter"), ("deals", "deal", "dealz", "hotdeals"), ("offers", "offer", "offerz"), ("coupons", "coupon", "couponz"),
    ("pill", "pillz", "mypills24", "pillstore", "diet-pill"), ("pharma", "pharmacy", "pharm", "epharma"), ("meds", "medz", "rxmeds"), ("steroid", "steroids", "steroidz"), ("viagra", "viagras", "viagrax"),
    ("adserver", "adserve", "adserv", "adservice", "ads24"), ("adclick", "adclicks", "clickads", "ad", "adz"), ("tracker", "tracking", "trackers", "tracks", "clicktrack"), ("banner", "banners", "bannerad"),
    ("popup", "popups", "popunder", "popad"), ("clicks", "clicker", "clickz", "click"), ("affiliate", "affiliates", "affil"), ("telemetry", "telemetrics", "telemeter"),
    ("xxx", "xxxx", "xxxtube"), ("porn", "porno", "pornos", "porntube"), ("sexy", "sex", "sexcam", "sexx"), ("webcams", "cams", "livecam", "camgirls"), ("nude", "nudes", "nudez"), ("escort", "escorts", "escortz"),
    ("warez", "warezz", "wareztown"), ("cracked", "cracks", "crackz"), ("keygen", "keygens", "keygenz"), ("torrent", "torrents", "torrentz"), ("hacked", "hacks", "hackz"),
    ("loans", "loan", "payloan", "loanz"), ("cash", "cashback", "cashfast", "ecash"), ("credits", "credit", "creditz"), ("spammer", "spam", "spammy"), ("replica", "replicas", "replicaz"),
)
WANTED = """
    news docs wiki library blog museum science school garden history recipes travel music weather maps forum journal city council photo gallery theatre academy archive
    books review sports football cycling hiking cooking bakery hotel airport railway bus harbour market farm forest river mountain village church hospital clinic doctor
    law court police parliament census budget energy water solar wind climate ocean biology chemistry physics maths astronomy robotics software open source python data
    research paper thesis student teacher campus alumni kindergarten family children toys games chess puzzle film cinema radio television podcast magazine daily times
    herald tribune observer guardian monitor bulletin notes diary story poetry novel author editor press print design art craft wood metal stone glass paint colour
    house home kitchen bath roof tools repair car bike boat plane train truck road bridge tower castle park zoo aquarium beach island lake valley desert bird fish horse
    dog cat insect flower tree seed fruit apple orange lemon bread cheese wine beer coffee tea sugar salt pepper tracy admiral adobe winter window winston freedom freeman
    betty alphabet spill pillow trackside clicquot dealer bannerman cambridge camera essex medicine credible lonely sparse hackney crackers slotter popular
""".split()
HOSTS = ("{a}.example.com", "{a}-{b}.example.net", "www.{b}{a}.example.org", "m.{a}-{b}.example.com", "{b}.{a}.example")
PATHS = ("/en/{}", "/fr/{}/", "/de/{}.html", "/es/{}?page=2", "/articles/{}", "", "/{}/{}")


def invented(n: int) -> list[str]:
    """Words of two or three syllables, made by rule: what names are like that mean nothing."""
    onsets, vowels, codas = "b c d f g h j k l m n p r s t v w z br ch dr fl gr kl pr sh sk st th tr".split(), "a e i o u ai ea ou".split(), ["", "", "l", "n", "r", "s", "t", "nd", "rk", "sh"]
    pick = lambda of, *at: of[crc32(repr(at).encode()) % len(of)]
    return ["".join(pick(onsets, i, j, 0) + pick(vowels, i, j, 1) + pick(codas, i, j, 2) for j in range(2 + i % 2)) for i in range(n)]


def labelled_urls(unwanted: list[str] | None = None, wanted: list[str] | None = None, others: int = 150) -> list[tuple[str, int]]:
    """url, 1 to block: each word, and ``others`` invented ones, under each kind of host, beside another of its class, with paths in turn."""
    out = []
    for label, words in enumerate(((wanted or WANTED) + invented(others), unwanted or [form for family in UNWANTED for form in family])):
        for w, word in enumerate(words):
            for h, host in enumerate(HOSTS):
                n = 31 * w + 7 * h
                path = PATHS[(w + h) % len(PATHS)].format(1 + 97 * n % 1999, 1 + n % 89)
                out.append((f"https://{host.format(a=word, b=words[(w * 5 + h * 11 + 3) % len(words)])}{path}", label))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path as the columns of ``judge`` have them."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:]
    stop = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def features(host: str, path: str) -> np.ndarray:
    """Distinct buckets of the character n-grams of the marked host and path."""
    out = set()
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        raw = text.encode()
        out.update(crc32(raw[i : i + n], ord(kind)) % BUCKETS for n in GRAMS for i in range(len(raw) - n + 1))
    return np.fromiter(sorted(out), np.int64)


class Weights(NamedTuple):
    """A bucket's rarity in the table (none for those it lacks) and its weight times that; the bias."""

    rarity: np.ndarray
    weight: np.ndarray
    bias: float


def train(table: list[tuple[str, int]], ridge: float = 1e-5, rate: float = 40.0) -> Weights:
    """Full gradient descent. An n-gram counts by its rarity, so what all URLs have tells little, and a URL's n-grams have a norm of about one."""
    rows = [features(*split_url(u)) for u, _ in table]
    if not rows:
        return Weights(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0)
    y = np.array([label for _, label in table], float)
    ids, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    starts = np.cumsum(sizes) - sizes
    times = np.bincount(ids, minlength=BUCKETS)
    rarity = np.where(times > 0, np.log(len(y) / np.maximum(times, 1)), 0.0)
    share = rarity[ids] / np.repeat(np.sqrt(np.add.reduceat(rarity[ids] ** 2, starts) + SHORT), sizes)
    weights, bias = np.zeros(BUCKETS), 0.0
    for _ in range(STEPS):
        off = 1 / (1 + np.exp(-(np.add.reduceat(weights[ids] * share, starts) + bias))) - y
        weights -= rate * (np.bincount(ids, np.repeat(off, sizes) * share, BUCKETS) / len(y) + ridge * weights)
        bias -= 0.1 * rate * off.mean()
    return Weights(rarity.astype(np.float32), (weights * rarity).astype(np.float32), bias)


@lru_cache
def default_weights() -> Weights:
    return train(labelled_urls())


def probability(host: str, path: str, weights: Weights) -> float:
    """That the URL is to be blocked. n-grams that the table lacks count nothing, so a host in unknown words is told by the bias."""
    ids = features(host, path)
    rarity = weights.rarity[ids].astype(np.float64)
    logit = weights.weight[ids].sum(dtype=np.float64) / np.sqrt((rarity * rarity).sum() + SHORT) + weights.bias
    return float(1 / (1 + np.exp(-logit)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: tuple = RULES, table: list[tuple[str, int]] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (that decided, or null), verdict, block_score (the model's, null where a rule decided)."""
    weights = default_weights() if table is None else train(table)
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("__url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):  # later ones win
        h, p = text.split("/", 1)
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(f"/{p}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ruled = batch.column("rule").is_valid().to_pylist()
            scores = [None if r else probability(h, p, shared.value) for r, h, p in zip(ruled, batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "block_score"])

    ruled = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    scored = ruled.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, block_score double")
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("block_score") > 0.5, "block").otherwise("allow")))
