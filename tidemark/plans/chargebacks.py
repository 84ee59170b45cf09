"""Dispute case files: deadlines, amounts, liability, identity match and evidence.

The disputes of the last days are few next to the payments.  Every large table is
therefore first cut down by a semi-join with the ids of the open cases, which Spark
does by broadcasting those ids while they are few, before anything is joined for real.
JSON texts are read before any exchange, so that only what is taken from them is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codes
from tidemark.functions.jsonops import first_text, text_at
from tidemark.functions.temporal import ntz, whole_days
from tidemark.functions.text import any_like, code_map, concat_skip_null, strip_chars
from tidemark.operators.latest import first_per_key, latest_per_key
from tidemark.operators.lookup import near
from tidemark.sinks.tables import parked

Tables = Mapping[str, DataFrame]

APPROVED_EVENTS = ("payment_execution", "payment_approved", "payment_execute")


def acquirer_reference(raw: Column | str) -> Column:
    """Reference number of a dispute, under whichever spelling the processor used."""
    return first_text(raw, *codes.ARN_KEYS)


def recent_disputes(t: Tables, as_of: object, days: int = 5) -> DataFrame:
    """Disputes that came in during the last days, at any stage."""
    return t["chargebacks"].filter(F.col("inserted_at") > ntz(as_of) - F.expr(f"interval {int(days)} day"))


def first_disputes(t: Tables, as_of: object, days: int = 5) -> DataFrame:
    return recent_disputes(t, as_of, days).filter(F.col("status") == "1st_chargeback")


# --- identity match -------------------------------------------------------------------

def identity_cases(t: Tables, as_of: object, days: int = 5) -> DataFrame:
    """Identity disputes with the names on the card and on the account."""
    cb = first_disputes(t, as_of, days).filter(F.col("reason_code").isin(codes.IDENTITY_REASONS)).select(
        "payment_id", "posted_at", acquirer_reference("raw_data").alias("arn"))
    users = t["end_users"].select(F.col("id").alias("end_user_id"), "first_name", "last_name",
                                  F.col("created_at").alias("account_created_at"))
    pay = near(t["payments"].withColumnRenamed("id", "payment_key").withColumnRenamed("payment_id", "long_id")
               .withColumnRenamed("payment_key", "payment_id"), cb, "payment_id")
    last4 = near(t["proc_requests"].select(
        "payment_id", text_at("raw_response", "last4Digits").alias("last4"), "created_at", "id").filter("last4 is not null"), cb, "payment_id")
    last4 = latest_per_key(last4, "payment_id", ["created_at", "id"]).select("payment_id", "last4")
    return (
        cb.join(pay, "payment_id").join(users, "end_user_id").join(last4, "payment_id", "left")
        .select("payment_id", "posted_at", "arn", "cc_identifier", "end_user_id", "pay_to_partner_id", "first_name", "last_name",
                "first_name_card", "last_name_card", "last4",
                concat_skip_null("first_name_card", F.lit(" "), "last_name_card").alias("card_name"),
                concat_skip_null("first_name", F.lit(" "), "last_name").alias("account_name")))


def undisputed_history(t: Tables, cases: DataFrame) -> DataFrame:
    """Settled payments and disputes of each card under dispute, by the same user.

    A semi-join finds the payments, so no pair of a payment and a case is ever built.
    """
    owners = cases.filter(F.col("cc_identifier").isNotNull()).select("cc_identifier", "end_user_id").distinct()
    mine = t["payments"].filter("status = 2").select("id", "cc_identifier", "end_user_id").join(
        owners, ["cc_identifier", "end_user_id"], "left_semi")
    cb = t["chargebacks"].select(F.col("payment_id").alias("id"), acquirer_reference("raw_data").alias("arn"))
    return mine.join(near(cb, mine, "id"), "id", "left").groupBy("cc_identifier").agg(
        F.countDistinct("id").alias("payments"), F.countDistinct("arn").alias("disputes"))


def undisputed_wallet_history(t: Tables, cases: DataFrame) -> DataFrame:
    """The same for wallet payments, which have no card number: by the last four digits."""
    digits = cases.filter(F.col("last4").isNotNull()).select("last4").distinct()
    mine = t["payments"].filter(F.col("cc_identifier").isNull() & (F.col("status") == 2)).select("id")
    wallet = t["proc_requests"].filter((F.col("tx_type") == "capture-authorization") & (F.col("payment_instrument_type") == "google_pay"))
    wallet = wallet.select(F.col("payment_id").alias("id"), text_at("raw_response", "last4Digits").alias("last4"))
    wallet = wallet.join(digits, "last4", "left_semi").join(mine, "id", "left_semi").distinct()
    cb = t["chargebacks"].select(F.col("payment_id").alias("id"), acquirer_reference("raw_data").alias("arn"))
    return wallet.join(near(cb, wallet, "id"), "id").groupBy("last4").agg(
        F.countDistinct("id").alias("wallet_payments"), F.countDistinct("arn").alias("wallet_disputes"))


def transaction_age(t: Tables, cases: DataFrame) -> DataFrame:
    """Days from the last successful capture to the posting of the dispute."""
    captures = near(t["proc_requests"].filter("tx_type = 'capture-authorization' and status = 'success'"), cases, "payment_id")
    newest = captures.groupBy("payment_id").agg(F.max("updated_at").alias("captured_at"))
    return cases.select("payment_id", "posted_at").join(newest, "payment_id").select(
        "payment_id", whole_days("posted_at", "captured_at").alias("days"))


def avs_matches(processor: Column, response: Column) -> Column:
    """Did the address check match, in the processor's own code?"""
    return _avs_in(processor, response, codes.AVS_MATCH)


def _avs_code(processor: Column, response: Column) -> Column:
    return (
        F.when(processor == "ecp", text_at(response, "avs_response_code"))
        .when(processor == "paysafe", text_at(response, "avsResponse"))
        .when(processor == "safecharge", text_at(response, "paymentOption", "card", "avsCode")))


def _avs_in(processor: Column, response: Column, lists: Mapping[str, Sequence[str]]) -> Column:
    code = _avs_code(processor, response)
    hit = F.lit(False)
    for name, accepted in lists.items():
        hit = hit | ((processor == name) & code.isin(list(accepted)))
    return F.coalesce(hit, F.lit(False))


def _decision_features(t: Tables, cases: DataFrame, house: codes.House) -> DataFrame:
    inner = text_at("variables", "Analytic", "variables", "Analytic")
    names = ["buyer_email_name_match_level", "buyer_ekata_email_name_match", "buyer_ekata_address_phone_match",
             "buyer_ekata_name_phone_match", "buyer_phone_name_to_card_name_match_ea_ekata"]
    d = t["decisions"].filter(F.col("application_name") == house.deciding_application).withColumn("inner", inner).select(
        "payment_id", "created_at", "id", *[text_at("inner", n).alias(n) for n in names],
        (text_at("inner", "user_has_approved_kyc_from_broker") == "true").alias("kyc"),
        (text_at("inner", "user_verified_by_selfie") == "true").alias("selfie"),
        F.coalesce(text_at("inner", "name_on_payment_method_instrument_to_name_in_poid_valid_for_current_payment_match"),
                   text_at("inner", "name_on_card_to_name_in_poid_valid_for_current_payment_match")).alias("instrument_name"))
    return latest_per_key(near(d, cases, "payment_id"), "payment_id", ["created_at", "id"]).drop("created_at", "id")


def _ip_features(t: Tables, cases: DataFrame) -> DataFrame:
    """Distance, accuracy and risk from the newest enrichment of each case."""
    return _enrichment(
        t, cases, text_at("data", "billing_address", "distance_to_ip_location").try_cast("double").alias("distance"),
        text_at("data", "ip_address", "location", "accuracy_radius").try_cast("double").alias("accuracy"),
        text_at("data", "ip_address", "risk").try_cast("double").alias("risk"))


def _enrichment(t: Tables, ids: DataFrame, *parts: Column) -> DataFrame:
    """Some parts of the ``data`` of each payment's newest enrichment."""
    r = near(t["r_payments"].withColumnRenamed("payment_ref", "payment_id"), ids, "payment_id").withColumnRenamed("id", "r_payment_id")
    r = r.join(near(t["maxmind_triggers"], r, "r_payment_id"), "r_payment_id").select("payment_id", "enrich_maxmind_id")
    em = near(t["enrich_maxmind"].select(F.col("id").alias("enrich_maxmind_id"), *parts), r, "enrich_maxmind_id")
    return latest_per_key(r.join(em, "enrich_maxmind_id"), "payment_id", ["enrich_maxmind_id"]).drop("enrich_maxmind_id")


def _in_fraud_ring(t: Tables, cases: DataFrame) -> DataFrame:
    r = near(t["r_payments"].withColumnRenamed("payment_ref", "payment_id"), cases, "payment_id").withColumnRenamed("id", "r_payment_id")
    names = F.transform(F.from_json("tags", "array<struct<name:string>>"), lambda x: x["name"])
    named = t["r_payment_tags"].select("r_payment_id", "inserted_at", F.exists(names, lambda n: n.ilike("%fraud ring%")).alias("ring"))
    tags = near(named, r, "r_payment_id").join(r, "r_payment_id")
    return latest_per_key(tags, "payment_id", ["inserted_at"]).filter("ring").select("payment_id", F.lit(True).alias("ring"))


def identity_match(t: Tables, as_of: object, days: int = 5, as_written: bool = False, house: codes.House = codes.EXAMPLE) -> DataFrame:
    """Score of the evidence that buyer and card holder are one person, with its parts.

    The first digit of the reference number tells the scheme: 7 and 2 Visa, 8 and 0
    Mastercard; for one US broker 7 is priced as Mastercard.  ``as_written`` keeps the
    original precedence of the verification rule, by which a selfie alone scores 0.
    """
    cases = parked(identity_cases(t, as_of, days))
    auth = t["proc_requests"].filter("tx_type = 'authorization'").select(
        "payment_id", "created_at", "id", avs_matches(F.col("processor"), F.col("raw_response")).alias("avs"))
    avs = latest_per_key(near(auth, cases, "payment_id"), "payment_id", ["created_at", "id"]).select("payment_id", "avs")
    partners = t["partners"].select(F.col("id").alias("pay_to_partner_id"), F.col("full_name").alias("partner"))
    x = (
        cases.join(partners, "pay_to_partner_id", "left").join(_decision_features(t, cases, house), "payment_id", "left")
        .join(_ip_features(t, cases), "payment_id", "left").join(_in_fraud_ring(t, cases), "payment_id", "left")
        .join(transaction_age(t, cases), "payment_id", "left").join(avs, "payment_id", "left")
        .join(undisputed_history(t, cases), "cc_identifier", "left").join(undisputed_wallet_history(t, cases), "last4", "left"))

    def no(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    digit = F.left("arn", F.lit(1))
    visa, master = no(digit.isin("7", "2")), no(digit.isin("8", "0"))
    us = no((F.col("partner") == house.us_broker) & (digit == "7"))

    def points(cond: Column, for_us: float, for_visa: float, for_master: float) -> Column:
        cond = no(cond)
        return F.when(cond & us, for_us).when(cond & visa, for_visa).when(cond & master, for_master).otherwise(0.0)

    def matches(*names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | no(F.col(n).isin("full_match", "partial_match"))
        return out

    far, acc, risk = F.col("distance"), F.col("accuracy"), F.col("risk")
    ip = ((far < 100) & (acc != 25) & (risk != 5)) | ((far > 100) & (acc < 25) & (risk < 5))
    history = no(F.col("payments") > F.col("disputes")) | no(F.col("wallet_payments") > F.col("wallet_disputes"))

    fa, la, fc, lc = (F.lower(c) for c in ("first_name", "last_name", "first_name_card", "last_name_card"))
    short = F.length("last_name") <= 2
    same_name = (
        no(F.lower("card_name") == F.lower("account_name"))
        | no((F.left(fa, F.lit(1)) == F.left(fc, F.lit(1))) & (la == lc))
        | no((fa == fc) & short & (F.left(la, F.lit(2)) == F.left(lc, F.lit(2))))
        | no((fa == fc) & ~short & (F.left(la, F.lit(3)) == F.left(lc, F.lit(3))))
        | no((fa == lc) & (fc == la)))
    owner = F.when(same_name & (visa | master), points(same_name, 0.15, 0.1, 0.15)).otherwise(
        points(F.col("partner").isNotNull() & matches("instrument_name"), 0.1, 0.1, 0.15))

    kyc, selfie = no(F.col("kyc")), no(F.col("selfie"))
    verified = F.when(us & (kyc | selfie), 0.1)
    if as_written:
        verified = verified.when(selfie, 0.0).when(master & kyc, 0.1).otherwise(0.0)
    else:
        verified = verified.when(master & (kyc | selfie), 0.1).otherwise(0.0)

    parts = {
        "kyc": verified, "ip_match": points(ip, 0.1, 0.1, 0.1), "cc_owner_match": owner,
        "avs_match": points(F.col("avs"), 0.2, 0.25, 0.2),
        "phone_match": points(matches("buyer_ekata_address_phone_match", "buyer_ekata_name_phone_match",
                                      "buyer_phone_name_to_card_name_match_ea_ekata"), 0.15, 0.15, 0.15),
        "email_match": points(matches("buyer_email_name_match_level", "buyer_ekata_email_name_match"), 0.2, 0.15, 0.2),
        "undisputed_past": points(history, 0.1, 0.25, 0.1),
    }
    x = x.withColumns(parts)
    total = F.lit(0.0)
    for name in parts:
        total = total + F.col(name)
    return x.select("payment_id", F.round(total, 2).alias("rank"), *parts, no(F.col("ring")).alias("in_fraud_ring"),
                    no(F.col("days") > 120).alias("late_dispute")).distinct()


# --- evidence -------------------------------------------------------------------------

def delivered(t: Tables, ids: DataFrame) -> DataFrame:
    """Block chain transactions of some payments: ``(payment_id, txn_hash)``."""
    log = near(t["payment_events_log"], ids, "payment_id").select(F.col("id").alias("event_id"), "payment_id")
    done = t["execution_responses"].filter(F.col("blockchain_txn_hash").isNotNull())
    return log.join(near(done, log, "event_id"), "event_id").select(
        "payment_id", F.col("blockchain_txn_hash").alias("txn_hash")).distinct()


def explorer_link(coin: Column, address: Column, txn_hash: Column) -> Column:
    """Where the delivery can be looked up; 'error' for coins without a rule."""
    prefix = code_map(coin, codes.EXPLORERS)
    return (
        F.when(coin.isin(codes.ADDRESS_COINS), concat_skip_null(prefix, address))
        .when(coin.isin(codes.HEX_COINS), concat_skip_null(prefix, F.lit("0x"), txn_hash))
        .when(coin == "HBAR", concat_skip_null(prefix, F.regexp_replace(txn_hash, "[-.]", "")))
        .when(prefix.isNotNull(), concat_skip_null(prefix, txn_hash))
        .when((coin == "BNB") & ~address.like("0x%"), concat_skip_null(F.lit(codes.EXPLORER_BNB), txn_hash))
        .when(coin.isin("BNB", "BNB-SC") & address.like("0%"), concat_skip_null(F.lit(codes.EXPLORER_BSC), txn_hash))
        .otherwise("error"))


def explorer_links(t: Tables, peers: DataFrame) -> DataFrame:
    pay = t["payments"].select(F.col("id").alias("payment_id"), "crypto_currency", "crypto_currency_address")
    pay = near(pay.filter(F.col("crypto_currency_address").isNotNull()), peers, "payment_id")
    link = explorer_link(F.col("crypto_currency"), F.col("crypto_currency_address"), F.col("txn_hash"))
    return peers.join(pay, "payment_id").select("payment_id", link.alias("blockchain_link"))


def avs_answers(t: Tables, peers: DataFrame) -> DataFrame:
    """Address check of delivered payments: matched, not sent, and the answer itself."""
    processor, response = F.col("processor"), F.col("raw_response")
    value = F.when(processor == "ecp", F.right(_avs_code(processor, response), F.lit(1))).when(
        processor.isin("paysafe", "safecharge"), _avs_code(processor, response)).otherwise("Unknown")
    auth = t["proc_requests"].filter("tx_type = 'authorization' and status = 'success'").select(
        "payment_id", avs_matches(processor, response).alias("avs"),
        _avs_in(processor, response, codes.AVS_NOT_SENT).alias("avs_check"), value.alias("avs_value"))
    return near(auth, peers, "payment_id").distinct()


def authentication_evidence(t: Tables, peers: DataFrame) -> DataFrame:
    """What proves the card holder was authenticated: ECI, CAVV, card and authorisation code."""
    cards = t["cc_identifiers"].select(F.col("identifier").alias("cc_identifier"), "credit_card")
    code = concat_skip_null(
        text_at("raw_response", "authorization_code"), text_at("raw_response", "authCode"),
        F.substring(text_at("raw_response", "POS-GWLink", "AuthorisationResponse", "Transaction", "HostResponse", "AuthorisationCode"), 12, 6))
    done = t["proc_requests"].filter("status = 'success'").select(
        "payment_id", "cc_identifier", text_at("threeds", "eci").alias("eci"), text_at("threeds", "cavv").alias("cavv"), code.alias("auth_code"))
    done = near(done.filter(F.col("cavv").isNotNull()), peers, "payment_id")
    return done.join(near(cards, done, "cc_identifier"), "cc_identifier").select("payment_id", "eci", "cavv", "credit_card", "auth_code").distinct()


def answered_eci(t: Tables, peers: DataFrame) -> DataFrame:
    """Indicator in the processor's answer, for authenticated payments."""
    done = t["proc_requests"].filter((F.col("status") == "success") & text_at("threeds", "cavv").isNotNull())
    done = done.select("payment_id", text_at("raw_response", "paymentOption", "card", "threeD", "eci").alias("answer_eci"))
    return near(done, peers, "payment_id").distinct()


def fraud_type(processor: Column, code: Column, name: Column, arn: Column, nine_is_mastercard: bool = True) -> tuple[Column, Column]:
    """Type and description of a fraud warning, by processor and first digit of the reference."""
    ecp = {c: (kind, text) for c, kind, text in codes.ECP_WARNINGS}
    other = {c: (kind, text) for c, kind, text in codes.SAFECHARGE_WARNINGS}
    out = []
    for i in (0, 1):
        by_scheme = F.lit(None).cast("string")
        for who, warning, digits, *answer in reversed(codes.SCHEME_WARNINGS):
            if nine_is_mastercard and answer[0] == "M5":
                digits += "9"
            seen = code if who == "ecp" else name
            by_scheme = F.when((processor == who) & (seen == warning) & F.left(arn, F.lit(1)).isin(list(digits)), answer[i]).otherwise(by_scheme)
        plain = F.when(processor == "ecp", code_map(code, {k: v[i] for k, v in ecp.items()})).when(
            processor == "safecharge", code_map(name, {k: v[i] for k, v in other.items()}))
        out.append(F.coalesce(by_scheme, plain))
    return out[0], out[1]


def fraud_types(t: Tables, as_of: object, days: int = 5, nine_is_mastercard: bool = True) -> DataFrame:
    """Warning type and description per disputed payment; type 'Unknown' when there is none."""
    cb = recent_disputes(t, as_of, days).select("payment_id", acquirer_reference("raw_data").alias("arn"))
    auth = near(t["proc_requests"].filter("tx_type = 'authorization' and status = 'success'"), cb, "payment_id")
    fw = near(t["fraud_warnings"], cb, "payment_id").select("payment_id", "fraud_type_code", text_at("raw_data", "fraudType").alias("fraud_name"))
    rows = auth.select("payment_id", "processor").join(cb, "payment_id").join(fw, "payment_id", "left")
    kind, text = fraud_type(F.col("processor"), F.col("fraud_type_code"), F.col("fraud_name"), F.col("arn"), nine_is_mastercard)
    return rows.select("payment_id", F.coalesce(kind, F.lit("Unknown")).alias("fraud_type"), text.alias("fraud_description")).distinct()


def device_details(t: Tables, as_of: object, days: int = 5) -> DataFrame:
    """Account, address, place and device of a disputed payment, from its first authorising visit."""
    cb = recent_disputes(t, as_of, days).select("payment_id").distinct()
    pay = t["payments"].select(F.col("id"), "end_user_id").withColumnRenamed("id", "payment_id")
    pay = near(pay, cb, "payment_id")
    visits = t["user_browser_events"].filter("event_type = 'authorize'").select(
        "payment_id", "id", text_at("request_data", "session", "ip").alias("ip_address"), "device_id")
    visits = first_per_key(near(visits, cb, "payment_id"), "payment_id", [F.col("id").asc()]).drop("id")
    users = t["end_users"].select(F.col("id").alias("end_user_id"), "first_name", "last_name", F.col("created_at").alias("registration_date"))
    ip = ["city", "subdivisions", "postal", "country"]
    steps = {"city": ("names", "en"), "subdivisions": (0, "names", "en"), "postal": ("code",), "country": ("names", "en")}
    place = []
    for k in ip:
        place += [text_at("data", "ip_address", k, *steps[k]), F.lit(" ")]
    distance = text_at("data", "billing_address", "distance_to_ip_location")
    # without an enrichment the parts below are NULL, and so is their text; `concat_skip_null` of nothing is not
    found = _enrichment(
        t, cb, F.lit(True).alias("enriched"), concat_skip_null(*place[:-1]).alias("place"), F.when(distance == "0", "<10").otherwise(distance).alias("bill_add_dist"),
        text_at("data", "ip_address", "location", "accuracy_radius").try_cast("double").alias("accuracy_radius"),
        text_at("data", "ip_address", "risk").try_cast("double").alias("proxy_score"))
    x = pay.join(visits, "payment_id").join(users, "end_user_id", "left").join(found, "payment_id", "left")
    nowhere = concat_skip_null(*[F.lit(None).cast("string") if i % 2 == 0 else p for i, p in enumerate(place[:-1])])
    return x.select(
        "payment_id", concat_skip_null("first_name", F.lit(" "), "last_name").alias("full_acc_name"), "registration_date",
        "ip_address", F.when(F.col("enriched"), F.col("place")).otherwise(nowhere).alias("ip_location"),
        "bill_add_dist", "accuracy_radius", "proxy_score", "device_id")


def last_four_digits(t: Tables, since: object = "2022-01-01") -> DataFrame:
    """Last digits of the card, from the card store, the wallet's display name or the processor.

    Card and wallet-name answers cover payments disputed since a day; processor answers
    cover settled wallet payments of the users behind such disputes.
    """
    cb = t["chargebacks"].filter(F.col("inserted_at") > ntz(since)).select("payment_id").distinct()
    pay = t["payments"].select(F.col("id"), "bin", "cc_identifier", "end_user_id", "status").withColumnRenamed("id", "payment_id")
    auth = t["proc_requests"].filter(
        (F.col("tx_type") == "authorization") & (F.col("status") == "success") & (F.col("payment_instrument_type") != "google_pay"))
    mine = near(near(pay, cb, "payment_id"), near(auth, cb, "payment_id"), "payment_id")
    cards = t["cc_identifiers"].select(F.col("identifier").alias("cc_identifier"), "credit_card")
    stored = near(t["payment_credit_cards"], cb, "payment_id")
    shown = t["wallet_attempts"].select(F.col("payment_instrument_id").cast("string").alias("credit_card_id"), "display_name")
    shown = stored.withColumn("credit_card_id", F.col("credit_card_id").cast("string")).join(shown, "credit_card_id").select("payment_id", "display_name")
    x = mine.join(near(cards, mine, "cc_identifier"), "cc_identifier", "left").join(shown, "payment_id", "left")
    scheme = any_like("bin", ["4%", "2%", "5%", "6%"])
    digits = F.when(scheme, F.right("credit_card", F.lit(4))).otherwise(F.right("display_name", F.lit(4)))
    from_cards = x.select("payment_id", digits.alias("last_4"))
    from_cards = first_per_key(from_cards, "payment_id", [F.col("last_4").asc_nulls_last()])

    wallet = t["proc_requests"].filter(F.col("payment_instrument_type") == "google_pay").select(
        "payment_id", "tx_type", text_at("raw_response", "last4Digits").alias("last_4"))
    owned = pay.select("payment_id", "end_user_id", "status")
    disputed = near(wallet.filter("tx_type = 'capture-authorization'"), cb, "payment_id").join(near(owned, cb, "payment_id"), "payment_id")
    known = parked(disputed.select("last_4", "end_user_id").distinct())
    theirs = near(owned.filter("status = 2"), known, "end_user_id")
    settled = wallet.join(theirs, "payment_id").join(known, ["last_4", "end_user_id"], "left_semi")
    from_wallets = first_per_key(settled.select("payment_id", "last_4"), "payment_id", [F.col("last_4").asc_nulls_last()])
    return from_cards.unionByName(from_wallets).distinct()


def disputed_by_card_and_day(t: Tables) -> DataFrame:
    """Disputed amount of each card per posting day, every payment counted once."""
    cb = t["chargebacks"].filter("status = '1st_chargeback'").select("payment_id", F.to_date("posted_at").alias("posted_on"))
    pay = t["payments"].filter(F.col("status").isin(codes.APPROVED_STATUSES)).select(
        F.col("id"), "cc_identifier", "total_amount_usd").withColumnRenamed("id", "payment_id")
    each = pay.join(cb, "payment_id").select("payment_id", "cc_identifier", "posted_on", "total_amount_usd").distinct()
    return each.groupBy("cc_identifier", "posted_on").agg(F.sum("total_amount_usd").alias("card_total"))


# --- the case file --------------------------------------------------------------------

def cases(t: Tables, as_of: object, days: int = 5, approved_events: Sequence[str] = APPROVED_EVENTS,
          house: codes.House = codes.EXAMPLE, everything: Tables | None = None) -> DataFrame:
    """First disputes of approved, executed payments, with deadlines, amounts, liability and parties.

    ``t`` may be the tables of the cases; the totals of their cards are then taken from ``everything``.
    """
    cb = first_disputes(t, as_of, days).filter(~F.col("reason_code").isin(codes.SKIPPED_REASONS)).select(
        "payment_id", "posted_at", "reason_code", F.col("status").alias("stage"), *_dispute_columns(F.col("raw_data")))
    log = near(t["payment_events_log"], cb, "payment_id").filter(
        F.col("name").isin(*approved_events) & F.col("partner_id").isin(list(house.executing_partners)))
    pay = t["payments"].withColumnRenamed("payment_id", "long_id").withColumnRenamed("id", "payment_id")
    pay = pay.filter(F.col("status").isin(codes.APPROVED_STATUSES)).withColumn("login_ip", text_at("login", "ip")).drop(
        "login", "partner_end_user_id", "end_user_id", "updated_at", "usd_rate")
    pay = near(near(pay, cb, "payment_id"), log, "payment_id")
    pr = near(t["proc_requests"].filter("tx_type = 'authorization' and status = 'success'").select(
        "payment_id", text_at("threeds", "eci").alias("eci"), text_at("threeds", "cavv").alias("cavv"),
        text_at("raw_response", "paymentOption", "card", "threeD", "eci").alias("answer_eci"), "payment_instrument_type"), cb, "payment_id")
    banks = t["binbase"].filter(F.col("issuing_organization").isNotNull() & (F.col("ver") == codes.BINBASE_VERSION)).select(
        "bin", "issuing_organization", "issuing_country_iso_a2").distinct()
    analyst = near(t["chargeback_decisions"], cb, "payment_id").select(
        "payment_id", F.col("fraud_type").alias("cd_type"), F.col("sub_fraud_type").alias("cd_sub"))
    warned = near(t["fraud_warning_classifications"], cb, "payment_id").select(
        "payment_id", F.col("fraud_type").alias("fwc_type"), F.col("sub_fraud_type").alias("fwc_sub"))
    flags = near(t["fraud_warnings"], cb, "payment_id").groupBy("payment_id").agg(F.max("reported_at").alias("warned_at"))
    names = t["partners"].select("id", "name", "full_name")
    quotes = near(t["quotes"].select("quote_id", "wallet_id", "digital_amount"), pay, "quote_id")
    wallets = near(names.select(F.col("name").alias("wallet_id"), F.col("id").alias("tk_id"), F.col("full_name").alias("tk_name")), quotes, "wallet_id")
    payees = names.select(F.col("id").alias("pay_to_partner_id"), F.col("full_name").alias("partner_name"))
    mids = t["processors_mids"].select(F.col("descriptor").alias("mid"), F.col("descriptor").alias("known_mid"),
                                    F.col("config").alias("mid_config"))
    processors = t["processors"].select(F.col("id").alias("processor_id"), F.col("name").alias("processor"))
    confirmed = near(t["user_browser_events"], cb, "payment_id").select(
        "payment_id", (F.col("event_type") == "confirm-coin-delivery").alias("confirmed")).distinct()

    x = parked(cb.join(pay, "payment_id")).withColumns({
        "created_on": F.to_date("created_at"), "posted_on": F.to_date("posted_at")})
    first, last = x.agg(F.min("created_on"), F.max("created_on")).first()
    em = t["enrich_maxmind"].filter(F.to_date("inserted_at").between(F.lit(first), F.lit(last))).select(
        text_at("request_data", "bin").alias("bin"), text_at("request_data", "i").alias("login_ip"),
        F.to_date("inserted_at").alias("created_on"), text_at("data", "credit_card", "issuer", "name").alias("issuer"))
    em = near(em, x, "bin", "login_ip", "created_on").distinct()
    totals = near(disputed_by_card_and_day(everything or t), x, "cc_identifier", "posted_on")
    x = (  # those by payment first, as each other key is an exchange of the whole rows
        x.join(pr, "payment_id").join(analyst, "payment_id", "left").join(warned, "payment_id", "left").join(flags, "payment_id", "left")
        .join(confirmed, "payment_id", "left").join(quotes.join(wallets, "wallet_id", "left").drop("wallet_id"), "quote_id", "left")
        .join(t["chargeback_types"], "reason_code", "left").join(processors, "processor_id", "left").join(mids, "mid", "left")
        .join(payees, "pay_to_partner_id", "left").join(banks, "bin", "left").join(em, ["bin", "login_ip", "created_on"], "left")
        .join(totals, ["cc_identifier", "posted_on"], "left"))
    return x.select(*_case_columns(house)).distinct()


def _dispute_columns(raw: Column) -> list[Column]:
    """What the case file takes from a dispute's text."""
    return [
        strip_chars(acquirer_reference(raw), "'").alias("arn"), text_at(raw, "amount").alias("raw_amount"),
        first_text(raw, "CB Posting Amount", "Posting Amount").alias("raw_posted"), text_at(raw, "chargebackAmount").alias("raw_disputed"),
        text_at(raw, "Original Transaction Currency").alias("raw_original"), text_at(raw, "currency").alias("raw_currency"),
        text_at(raw, "paymentMethod").alias("raw_method"), concat_skip_null(text_at(raw, "issuer_bank"), text_at(raw, "issuerBank")).alias("raw_bank"),
        first_text(raw, "original_transaction_unique_id", "Transaction ID", "transactionId").alias("raw_unique")]


def _case_columns(house: codes.House) -> list[Column]:
    payee, proc, kind = F.col("pay_to_partner_id"), F.col("processor"), F.col("chargeback_type")
    bin_, us = F.col("bin"), F.col("partner_name") == house.us_broker
    ten_days = payee.isin(list(house.ten_day_partners))

    def due(n: int) -> Column:
        return F.date_add(F.to_date("posted_at"), n)

    def yes(cond: Column) -> Column:
        return F.when(cond, "Yes").otherwise("No")

    template = F.when((kind == "fraud") & F.col("reason_code").isin(codes.TURNKEY_FRAUD_REASONS), "Turnkey Service Level").when(
        kind == "fraud", "Fraud").when(kind == "service_level", "Turnkey Service Level").otherwise("Error")
    fight = F.when((proc == "ecp") & any_like(bin_, ["4%", "5%", "6%"]), due(8)).when(proc == "paysafe", due(7)).when(
        (proc == "safecharge") & payee.isNotNull(), due(5))
    ab_fight = F.when((proc == "ecp") & bin_.like("4%"), due(21)).when((proc == "ecp") & bin_.like("5%"), due(30)).when(
        proc == "paysafe", due(15)).when((proc == "safecharge") & ten_days, due(10)).when(
        (proc == "safecharge") & payee.isNotNull(), due(14))
    eci, cavv, answer_eci = F.col("eci"), F.col("cavv"), F.col("answer_eci")
    shifted = cavv.isNotNull() & F.when(us, answer_eci.isin(codes.LIABILITY_SHIFT_ECI)).when(~us, eci.isin(codes.LIABILITY_SHIFT_ECI))
    amount = (
        F.when(proc == "ecp", (F.col("raw_amount").cast("decimal(20,2)") / -100).cast("decimal(10,2)").cast("string"))
        .when(proc == "paysafe", strip_chars(F.col("raw_posted"), ","))
        .when(proc == "safecharge", F.col("raw_disputed")))
    currency = F.when(proc == "ecp", "USD").when(proc == "paysafe", F.col("raw_original")).when(
        proc == "safecharge", F.col("raw_currency"))
    liable = F.col("tk_id").isNotNull() & (
        ((kind == "service_level") & payee.isin(list(house.liable_service_partners))) | ten_days | ((kind == "fraud") & cavv.isNull()))
    method, google = F.col("raw_method"), F.col("payment_instrument_type") == "google_pay"
    wallet = F.when(google, "GooglePay-").otherwise("ApplePay-")
    scheme = (
        F.when(bin_.like("4%"), "Visa").when(any_like(bin_, ["2%", "5%", "6%"]), "Mastercard")
        .when(bin_.isNull() & (method == "Visa"), F.concat(wallet, F.lit("Visa")))
        .when(bin_.isNull() & method.like("Master%"), F.concat(wallet, F.lit("Mastercard"))).otherwise("Error"))
    named = F.col("raw_bank")
    org = F.col("issuing_organization")
    bank = (
        F.when(F.col("issuer").isNotNull(), F.col("issuer"))
        .when(bin_.isNull() & org.isNull() & (named != ""), named)
        .when(bin_.isNotNull() & org.isNotNull(), org).otherwise("Unknown"))

    def mid_path(*parts: Column) -> Column:
        return F.call_function("get_json_object", F.col("mid_config"), F.concat(*parts))

    mid = F.coalesce(
        mid_path(F.lit("$.accounts."), F.col("currency"), F.lit(".account")), mid_path(F.lit("$.merchant."), F.col("currency")),
        text_at("mid_config", "merchant", "uId"), text_at("mid_config", "merchantId"))
    address = [F.col("address1"), F.col("city"), F.col("state"), F.col("country"), F.col("zipcode")]
    spaced = [p for c in address for p in (c, F.lit(" "))][:-1]
    return [
        template.alias("cb_template"), fight.alias("fight_until"), F.col("arn"),
        F.col("payment_id"), F.col("cc_identifier").alias("credit_card_identifier"),
        F.coalesce("cd_type", "fwc_type").alias("analysts_decision"), F.coalesce("cd_sub", "fwc_sub").alias("sub_classification"),
        F.when(payee.isin(list(house.top_up_partners)), "Top-Up").otherwise(F.col("crypto_currency")).alias("crypto_curr"),
        F.col("partner_name"), F.col("phone"), payee.alias("account_id"), yes(shifted).alias("threeds"),
        yes(F.col("warned_at").isNotNull()).alias("has_fw"), yes(F.col("status").isin(codes.REFUNDED_STATUSES)).alias("was_refunded"),
        kind.alias("cb_type"), F.col("reason_code"),
        F.coalesce(code_map("reason_code", codes.REASON_TEXT), F.col("reason_description")).alias("reason_description"),
        F.col("total_amount").cast("decimal(10,2)").alias("pay_amt"), F.col("currency").alias("pay_curr"), amount.alias("cb_amt"),
        currency.alias("cb_amt_curr"), F.col("total_amount_usd").cast("decimal(10,2)").alias("pay_amt_usd"),
        F.col("handling_at").alias("transaction_date"), F.to_date("posted_at").alias("cb_posting_date"), due(135).alias("final_decision_date"),
        F.lit("New").alias("status"), F.col("stage"), F.lit("TBD").alias("decision"), proc.alias("processor"),
        yes(liable).alias("is_company_liable"), scheme.alias("card_scheme"), bank.alias("issuing_bank"),
        F.coalesce("issuing_country_iso_a2", "country").alias("bin_country"), F.col("order_id").alias("partner_id"), F.col("long_id"),
        F.col("card_total").cast("decimal(10,2)").alias("total_amt_by_card"),
        F.col("raw_unique").alias("uti"), mid.alias("mid"),
        F.col("known_mid").alias("descriptor"),
        F.coalesce("tk_name", "known_mid").alias("turnkey_or_exchange"),
        F.col("tk_id"), F.col("crypto_currency_address").alias("crypto_address"), F.col("digital_amount").alias("crypto_amount"),
        strip_chars(concat_skip_null("first_name_card", F.lit(" "), "last_name_card"), ",.#").alias("full_name"), F.col("email"),
        strip_chars(concat_skip_null(*spaced), ",.#").alias("billing_address"), ab_fight.alias("ab_fight_until"),
        yes(F.col("confirmed")).alias("email_confirmation"),
    ]


# CRM field of each column of the case file.
CRM_FIELDS = {
    "cb_template": "Chargeback_Template__c", "fight_until": "Fight_Until__c", "arn": "Name", "payment_id": "Payment_ID__c",
    "credit_card_identifier": "CC_Identifier__c", "analysts_decision": "Fraud_Type__c", "tag": "Fraud_Ring__c",
    "sub_classification": "Sub_Fraud_Type__c", "crypto_curr": "Crypto_Currency__c", "partner_name": "Partner_Name__c",
    "account_id": "Partner_Account_Number__c", "threeds": "X3DS__c", "eci": "ECI__c", "has_fw": "Has_FW__c",
    "was_refunded": "Was_Refunded__c", "cb_type": "Chargeback_Type__c", "reason_code": "Reason_Code__c",
    "reason_description": "Reason_Description__c", "pay_amt": "Payment_Amount__c", "pay_curr": "Payment_Currency__c",
    "cb_amt": "CBA_Amount__c", "cb_amt_curr": "CB_Currency__c", "pay_amt_usd": "Payment_Amount_USD__c",
    "transaction_date": "Transaction_Date__c", "cb_posting_date": "Chargeback_Posting_Date__c",
    "final_decision_date": "Final_Decision_Date__c", "status": "Status__c", "stage": "Stage__c", "decision": "Decision__c",
    "processor": "ARN_not_used__c", "is_company_liable": "Is_Company_Liable__c", "card_scheme": "Card_Scheme__c",
    "issuing_bank": "Issuing_Bank__c", "bin_country": "Country__c", "partner_id": "Partner_ID__c", "long_id": "Long_ID__c",
    "total_amt_by_card": "Total_Amount_By_Card__c", "uti": "UTI__c", "mid": "MID__c", "descriptor": "Descriptor__c",
    "turnkey_or_exchange": "Turnkey_or_Partner_Name__c", "tk_id": "Turnkey_or_Partner_ID__c", "crypto_address": "Crypto_Address__c",
    "crypto_amount": "Crypto_Amount__c", "rank": "Identity_Match__c", "full_acc_name": "Chargeback_Account_Name__c",
    "registration_date": "Registration_Date__c", "ip_address": "IP_Address__c", "ip_location": "IP_Location__c",
    "bill_add_dist": "Billing_Address_Distance__c", "accuracy_radius": "Accuracy_Radius__c", "proxy_score": "Proxy_Score__c",
    "device_id": "Device_Id__c", "last_4": "Last_4_CC_Digits__c", "full_name": "Full_Name__c", "email": "Email__c",
    "billing_address": "Billing_Address__c", "ab_fight_until": "AB_Fight_Until_Date__c",
    "email_confirmation": "Has_Email_Confirmation__c", "blockchain_link": "Blockchain_Website__c", "phone": "Phone__c",
    "fraud_type": "Fraud_Type_code__c", "avs_value": "AVS_value__c", "avs": "AVS_Match__c", "avs_check": "AVS_Check__c",
    "details": "X3DS_Details__c",
}


def case_file(t: Tables, as_of: object, days: int = 5, cards_since: object = "2022-01-01",
              approved_events: Sequence[str] = APPROVED_EVENTS, house: codes.House = codes.EXAMPLE) -> DataFrame:
    """The whole case file under CRM names, one row per case and combination of its evidence."""
    base = parked(cases(t, as_of, days, approved_events, house))
    peers = parked(delivered(t, base))
    rings = near(t["fraud_ring_tags"], base, "payment_id").select("payment_id", "tag").distinct()
    x = base
    for part in (
        identity_match(t, as_of, days, house=house).select("payment_id", "rank"), explorer_links(t, peers), avs_answers(t, peers),
        authentication_evidence(t, peers), answered_eci(t, peers), rings,
        fraud_types(t, as_of, days).select("payment_id", "fraud_type").distinct(),
        device_details(t, as_of, days), near(last_four_digits(t, cards_since), base, "payment_id")):
        x = x.join(part, "payment_id", "left")
    us = F.col("partner_name") == house.us_broker
    proven = F.when(us, F.col("answer_eci").isin(codes.LIABILITY_SHIFT_ECI)).when(
        ~us, F.col("eci").isin(codes.LIABILITY_SHIFT_ECI) & F.col("cavv").isNotNull())
    text = concat_skip_null(F.lit("ECI "), "eci", F.lit(", CAVV: "), "cavv", F.lit(", Card Number "), "credit_card",
                            F.lit(", Auth Code: "), "auth_code")
    x = x.withColumns({
        "details": F.when(proven, text).otherwise("False"),
        "avs": F.when(F.col("avs"), "Yes").otherwise("No"), "avs_check": F.when(F.col("avs_check"), "Yes").otherwise("No")})
    return x.select(*[F.col(c).alias(field) for c, field in CRM_FIELDS.items()])


def case_updates(t: Tables, as_of: object, crm_ids: DataFrame | None = None,
                 house: codes.House = codes.EXAMPLE) -> DataFrame:
    """What the CRM has to learn about open cases: ring, warning type, and whether there is a warning.

    With ``crm_ids`` (``payment_key`` text, ``Id``) the rows carry the CRM's own id instead
    of the payment id.
    """
    day = ntz(as_of)
    open_cases = t["chargebacks"].filter(
        (F.col("posted_at") >= day - F.expr("interval 100 day")) & (F.col("status") == "1st_chargeback")).select("payment_id").distinct()
    warned = near(t["fraud_warnings"].filter(F.col("inserted_at") >= day - F.expr("interval 180 day")), open_cases, "payment_id")
    warned = warned.select("payment_id", F.lit(True).alias("warned")).distinct()
    rings = near(t["fraud_ring_tags"], open_cases, "payment_id").select("payment_id", "tag")
    kinds = fraud_types(t, as_of, 100, nine_is_mastercard=False)
    x = (
        open_cases.join(rings, "payment_id", "left").join(warned, "payment_id", "left").join(kinds, "payment_id", "left")
        .select("payment_id", F.when(F.col("tag") == house.mass_closing_tag, "").otherwise(F.col("tag")).alias("Fraud_Ring__c"),
                F.col("fraud_type").alias("Fraud_Type_code__c"), F.col("fraud_description").alias("Fraud_Type_Description__c"),
                F.when(F.col("warned"), "Yes").otherwise("No").alias("Has_FW__c")))
    if crm_ids is None:
        return x
    keyed = crm_ids.select(F.col("payment_key").try_cast("bigint").alias("payment_id"), "Id")
    return x.join(keyed, "payment_id").drop("payment_id")
