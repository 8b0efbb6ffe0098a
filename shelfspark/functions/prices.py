"""Price text, price choice and promotion text (FN1-FN8, FN31, FN32)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.select import first_truthy

# The currency codes a price may carry.
CURRENCY_CODES = """
AED AFN ALL AMD ANG AOA ARS AUD AWG AZN BAM BBD BDT BGN BHD BIF BMD BND BOB BOV BRL BSD BTN BWP BYR BZD
CAD CDF CHE CHF CHW CLF CLP CNH CNY COP COU CRC CUC CUP CVE CZK DJF DKK DOP DZD EGP ERN ETB EUR FJD FKP
GBP GEL GHS GIP GMD GNF GTQ GYD HKD HNL HRK HTG HUF IDR ILS INR IQD IRR ISK JMD JOD JPY KES KGS KHR KMF
KPW KRW KWD KYD KZT LAK LBP LKR LRD LSL LTL LYD MAD MDL MGA MKD MMK MNT MOP MRO MUR MVR MWK MXN MXV MYR
MZN NAD NGN NIO NOK NPR NZD OMR PAB PEN PGK PHP PKR PLN PYG QAR RON RSD RUB RWF SAR SBD SCR SDG SEK SGD
SHP SLL SOS SRD SSP STD SYP SZL THB TJS TMT TND TOP TRY TTD TWD TZS UAH UGX USD USN USS UYI UYU UZS VEF
VND VUV WST XAF XAG XAU XBA XBB XBC XBD XCD XDR XFU XOF XPD XPF XPT XSU XTS XUA XXX YER ZAR ZMW ZWD
""".split()

# Sale labels that mean a temporary price cut.
SALE_LABELS = ("OnSale", "Clearance")

# Fixed value: a number as shops print it.
NUMBER = r"\d{1,3}[,\d{3}]*\.?\d*"


def price_amount(text: Column) -> Column:
    """Amount in the first run of digits, dots and commas; null when it is not a number."""
    return F.regexp_replace(F.regexp_extract(text, r"[\d.,]+", 0), ",", "").try_cast("double")


def price_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def is_currency(code: Column) -> Column:
    return code.isin(CURRENCY_CODES)


def currency_or_default(code: Column, default: str = "USD") -> Column:
    return F.coalesce(code, F.lit(default))


def was_now(now: Column, was: Column) -> Column:
    """Text of both prices, only when both are present and not zero."""
    both = now.isNotNull() & was.isNotNull() & (now != 0) & (was != 0)

    def digits(amount: Column) -> Column:
        plain = amount.cast("string")
        whole = F.regexp_replace(amount.cast("decimal(30,2)").cast("string"), "0$", "")
        return F.when(plain.contains("E") & (F.abs(amount) >= 1), whole).otherwise(plain)

    return F.when(both, F.concat(digits(now), F.lit(", "), digits(was)))


def flat_price(declared: Column, text: Column) -> Column:
    return F.coalesce(first_truthy("number", declared), price_amount(text))


def seller_price(declared: Column, text: Column) -> Column:
    return F.coalesce(first_truthy("number", price_amount(text)), declared)


def subscribe_price(price: Column, percent: Column) -> Column:
    """Price after a subscription discount; ``price`` and ``percent`` are decimals."""
    given = (price != 0) & (percent != 0)
    return F.when(given, F.round(price * (F.lit(100).cast("decimal(5,0)") - percent) / F.lit(100).cast("decimal(5,0)"), 2))


def unit_price(text: Column) -> tuple[Column, Column]:
    """(amount text, unit) from ``$x Per unit``."""
    found = F.lower(F.regexp_extract(text, r"\$" + NUMBER + r" Per .+", 0))
    parts = F.split(found, " per ")
    hit = found != ""
    return (
        F.when(hit, F.trim(F.replace(F.get(parts, F.lit(0)), F.lit("$"), F.lit("")))),
        F.when(hit, F.trim(F.get(parts, F.lit(1)))),
    )


def price_cut(was: Column) -> Column:
    return F.coalesce(was != 0, F.lit(False))


def sale_label(label: Column) -> Column:
    return F.coalesce(label.isin(*SALE_LABELS), F.lit(False))


def buy_get_free(text: Column) -> Column:
    return first_truthy("string", F.regexp_extract(text, r"Buy (\d+) Get \d+ Free", 1))


def percent_saved(text: Column) -> Column:
    return first_truthy("string", F.regexp_extract(text, r"(" + NUMBER + r")\s*%", 1))


def amount_saved(text: Column) -> Column:
    return first_truthy("string", F.regexp_extract(text, r"\$(" + NUMBER + r")", 1))


def volume_discount(quantity: Column, price_label: Column) -> Column:
    """``quantity,price`` when both are present."""
    price = first_truthy("string", F.regexp_extract(price_label, NUMBER, 0))
    return F.concat(first_truthy("string", quantity), F.lit(","), price)


def minor_units(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def option_price(base: Column, delta: Column) -> Column:
    return F.round(base + F.coalesce(delta, F.lit(0)), 2)
