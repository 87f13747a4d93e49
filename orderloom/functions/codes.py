"""Fixed code tables and the column expressions that apply them.

All tables here are constants of fixed size, so they are folded into the plan as
expressions; no join and no broadcast is needed.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import col

# Organisation code to company number.
COMPANY_NUMBERS = {"FL-US": "21", "FL-CA": "45", "KFL-US": "22", "CH-CA": "77", "CH-US": "20"}

# Product-master division to organisation code.
BANNER_ORGS = {"03": "FL-US", "16": "KFL-US", "18": "CH-US", "76": "FL-CA", "77": "CH-CA"}
CANADA_ORGS = ("FL-CA", "CH-CA")
US_ORGS = ("FL-US", "KFL-US", "CH-US")
CANADA_BANNER, US_BANNER = "98", "81"

# Fulfilment status number to order status.
ORDER_STATUS = {
    1000: "SUBMITTED",
    1600: "FULFILMENT_PROCESSING", 2000: "FULFILMENT_PROCESSING", 3000: "FULFILMENT_PROCESSING",
    3500: "FULFILMENT_PROCESSING", 3600: "FULFILMENT_PROCESSING", 3700: "FULFILMENT_PROCESSING",
    7000: "FULFILMENT_COMPLETE", 7500: "FULFILMENT_COMPLETE",
    9000: "CANCELLED",
    13000: "WAIT_FRAUD_SYSTEM_CHECK",
}
# The order marts also know these, and put a failed fraud check after SUBMITTED.
MART_ORDER_STATUS = {**ORDER_STATUS, 1500: "SUBMITTED", 8000: "FULFILMENT_COMPLETE", 8500: "FULFILMENT_COMPLETE"}
SKIPPED_STATUSES = (8000, 8500)

# Return status number to return status.
RETURN_STATUS = {11000: "CREATED", 18000: "RETURN_COMPLETE", 19000: "CANCELLED"}

# Delivery method to fulfilment type.
FULFILMENT_TYPE = {
    "PICKUPATSTORE": "PICK", "SHIPTOADDRESS": "SHIP", "SHIPTOSTORE": "SHIP", "SHIPTORETURNCENTER": "SHIP",
    "EMAIL": "ELECTRONIC", "STORESALE": "XSTORE", "STORERETURN": "XSTORE",
}
# Order and exchange lines read return-centre shipments as pickups.
LINE_FULFILMENT_TYPE = {
    "PICKUPATSTORE": "PICK", "PICKUP_IN_STORE": "PICK", "SHIPTORETURNCENTER": "PICK",
    "SHIPTOADDRESS": "SHIP", "SHIPTOSTORE": "SHIP", "EMAIL": "ELECTRONIC",
    "STORERETURN": "STORE_RETURN", "STORESALE": "XSTORE",
}

# Location type to stock location kind.
LOCATION_KIND = {"DC": "WHSE", "SUPPLIER": "DROPSHIP", "STORE": "STORE"}
CENTRE_KIND = {"SUPPLIER": "Drop Ship", "STORE": "Store", "DC": "DC"}
CENTRE_CITY = {"RENO": "Reno", "CAMP HILL": "Camp Hill", "MILTON": "Milton", "JUNCTION CITY": "Junction City"}
RETURN_CITY = {"RENO": "RENO", "CAMP HILL": "CAMPHILL", "JUNCTION CITY": "JC", "MILTON": "MILTON"}

# Order type to order source.
ORDER_SOURCE = {"web": "CAS", "return": "CAS", "callcenter": "CUSTOMER_SVC", "savethesale": "XSTORE",
                "launch": "LAUNCH_RESERVATION"}
REFUND_SOURCE = {"web": "OMS_OBF_SVC", "return": "OMS_OBF_SVC", "callcenter": "CUSTOMER_SVC",
                 "savethesale": "XSTORE"}

# Payment type to tender name.
TENDER_TYPE = {
    "Affirm": "AFFIRM", "AliPay": "ALIPAY", "ApplePay": "APPLEPAY", "Cash": "CASH",
    "Credit Card": "CREDITCARD", "Gift Card": "GIFTCARD", "GooglePay": "PAYWITHGOOGLE",
    "In Store Credit Card": "INTERNAL", "Store Refund": "INTERNAL",
    "Klarna Account": "KLARNA_ACCOUNT", "PayPal": "PAYPAL", "Venmo": "VENMO", "WeChat": "WECHAT",
    "Other": "OTHER",
}
SHORT_TENDER_TYPE = {"Gift Card": "GIFTCARD", "Credit Card": "CREDITCARD"}
FUNDING_SOURCE = {"Credit Card": "CREDIT", "Debit Card": "DEBIT", "Gift Card": "PREPAID"}

# Transaction type to tender movement.
TENDER_MOVEMENT = {
    "Authorization": "CAPTURE", "Authorization Reversal": "CANCEL", "Refund": "REFUND",
    "Return Credit": "REFUND", "Settlement": "CAPTURE", "Void": "CANCEL",
}

# Card brand to card number class (all others: 9).
CARD_CLASS = {
    "VISA": "1", "MASTERCARD": "2", "MASTER": "2", "AMEX": "3", "DISCOVER": "4", "JCB": "5",
    "DINERS": "6", "DINERS_CLUB_INTERNATIONAL": "6",
    "VENMO": "7", "OTHER": "7", "WECHAT": "7", "KLARNA_ACCOUNT": "7", "PAYPAL": "7", "AFFIRM": "7",
    "PAYBRIGHT": "7", "KLARNA": "7", "ALIPAY": "7", "UNIONPAY": "8",
}

# Electronic gift card item to product number.
GIFT_CARD_PRODUCTS = {"ECARD20": "2138264", "ECARD21": "2138265", "ECARD22": "2138266",
                      "ECARD45": "20", "ECARD77": "2000003"}

# Published name of a selling channel, by its name without spaces and in capitals.
NETWORK_CHANNELS = {
    "FL-US-SHIPTOHOME": "FL_US_ECOMM",
    "FL-US-BOPIS": "FL_US_RETAIL",
    "FL-CA-SHIPTOHOME": "FL_CA_ECOMM",
    "FL-CA-BOPIS": "FL_CA_RETAIL",
    "CH-US-SHIPTOHOME": "CHP_US_ECOMM",
    "CH-US-BOPIS": "CHP_US_RETAIL",
    "CH-CA-SHIPTOHOME": "CHP_CA_ECOMM",
    "KFL-US-SHIPTOHOME": "KIDS_US_ECOMM",
    "KFL-US-BOPIS": "KIDS_US_RETAIL",
    "KFL-CA-SHIPTOHOME": "KIDS_CA_ECOMM",
}
LOCATION_CHANNELS = {
    "FL-US-SHIPTOHOME": "FL_US_ECOMM",
    "FL-US-BOPIS": "FL_US_ECOMM",
    "FL-CA-SHIPTOHOME": "FL_CA_ECOMM",
    "FL-CA-BOPIS": "FL_CA_ECOMM",
    "CH-US-SHIPTOHOME": "CHP_US_ECOMM",
    "CH-US-BOPIS": "CHP_US_ECOMM",
    "CH-CA-SHIPTOHOME": "CHP_CA_ECOMM",
    "CH-CA-BOPIS": "CHP_CA_ECOMM",
    "KFL-US-SHIPTOHOME": "KIDS_US_ECOMM",
    "KFL-US-BOPIS": "KIDS_US_ECOMM",
    "KFL-CA-SHIPTOHOME": "KIDS_CA_ECOMM",
}

# Return reason texts by reason code.
RETURN_REASONS = {
    "BW": ("BOSS WRONG ITEM",),
    "DI": ("DROP SHIP WRONG ITEM",),
    "DQ": ("DAMAGED", "DEFECTIVE ITEM", "DEFECTIVE ITEM NO RETURN FEE", "FLX DEFECTIVE ITEM",
           "FLX DEFECTIVE ITEM NO RETURN FEE", '["DEFECTIVE ITEM"]'),
    "EQ": ("EMBROIDERY QUALITY",),
    "FG": ("EB4KIDS FIT GUARNTEE",),
    "IS": ("RETURN", "RETURNREASON", "INSTORE CS RETURNS", "STORERETURN RETURNS", "DC RETURNS"),
    "LP": ("LOST PACKAGE",),
    "LS": ("DO NOT USE",),
    "ND": ("NOT DELIVERABLE",),
    "PA": ("WRONG ART GRAPHIC",),
    "PB": ("PERSONALIZED-BUYER",),
    "PC": ("COLOR MISMATCH", "WRONG COLOR"),
    "PI": ("PERSONALZD WRONG ITM",),
    "PN": ("PERSONALZD UNWANTED",),
    "PQ": ("PRINTING QUALITY",),
    "PS": ("MIS-SPELLING",),
    "PU": ("PERSONALIZED-AGENT",),
    "PW": ("DIDN'T HOLD UP",),
    "SN": ("STORE DID NOT REFUND",),
    "SY": ("STORE DID REFUND",),
    "TB": ("TOO BIG / LONG", "TOO BIG LONG", "TOO BIG/ LONG", "TOO BIG/ LONG NO RETURN FEE", "TOO LONG",
           "ITEM DOES NOT FIT", "FLX TOO BIG/ LONG", "FLX TOO BIG/ LONG NO RETURN FEE"),
    "TN": ("TOO NARROW", "TOO NARROW NO RETURN FEE", "FLX TOO NARROW", '["TOO NARROW"]'),
    "TS": ("TOO SMALL / SHORT", "TOO SMALL/ SHORT", "TOO SMALL/SHORT", "TOO SMALL/SHORT NO RETURN FEE",
           "FLX TOO SMALL/ SHORT", "FLX TOO SMALL/SHORT", "FLX TOO SMALL/ SHORT NO RETURN FEE"),
    "TW": ("TOO WIDE", "TOO WIDE NO RETURN FEE", "FLX TOO WIDE", "FLX TOO WIDE NO RETURN FEE", '["TOO WIDE"]'),
    "U": ("UNWANTED ITEM", "UNWANTED / CHANGED MY MIND", "UNWANTED/ CHANGED MY MIND",
          "UNWANTED/ CHANGED MY MIND NO RETURN FEE", "FLX UNWANTED/ CHANGED MY MIND"),
    "UC": ("USED CLEAT",),
    "US": ("USED SHOE NOT DEFECT",),
    "WD": ("ITEM NOT AS DESCRIBE", "ITEM NOT AS DESCRIBED/ PICTURED", "FLX ITEM NOT AS DESCRIBED/ PICTURED",
           '["ITEM NOT AS DESCRIBED/ PICTURED"]'),
    "WI": ("WRONG ITEM", "I ORDERED THE WRONG ITEM", "FLX I ORDERED THE WRONG ITEM", "WRONG ITEM SHIPPED",
           "FLX WRONG ITEM SHIPPED", '["WRONG ITEM SHIPPED"]'),
    "WO": ("WRONG ITEM ORDERED",),
    "WT": ("DAMAGED IN TRANSIT (THROW IN TRASH)",),
    "XX": ("XSTORE RETURN",),
}
# Reason number by reason code and organisation.
REASON_NUMBERS = {
    "BW": {"KFL-US": 262, "FL-US": 294, "FL-CA": 326, "CH-US": 390, "CH-CA": 548},
    "DI": {"KFL-US": 263, "FL-US": 295, "FL-CA": 327, "CH-US": 391, "CH-CA": 549},
    "DQ": {"KFL-US": 264, "FL-US": 296, "FL-CA": 328, "CH-US": 392, "CH-CA": 550},
    "EQ": {"KFL-US": 265, "FL-US": 297, "FL-CA": 329, "CH-US": 393, "CH-CA": 551},
    "IS": {"KFL-US": 267, "FL-US": 299, "FL-CA": 331, "CH-US": 395, "CH-CA": 553},
    "LS": {"KFL-US": 269, "FL-US": 301, "FL-CA": 333, "CH-US": 397, "CH-CA": 555},
    "LP": {"KFL-US": 270, "FL-US": 302, "FL-CA": 334, "CH-US": 398, "CH-CA": 556},
    "ND": {"KFL-US": 271, "FL-US": 303, "FL-CA": 335, "CH-US": 399, "CH-CA": 557},
    "PA": {"KFL-US": 272, "FL-US": 304, "FL-CA": 336, "CH-US": 400, "CH-CA": 558},
    "PB": {"KFL-US": 273, "FL-US": 305, "FL-CA": 337, "CH-US": 401, "CH-CA": 559},
    "PC": {"KFL-US": 274, "FL-US": 306, "FL-CA": 338, "CH-US": 402, "CH-CA": 560},
    "PI": {"KFL-US": 275, "FL-US": 307, "FL-CA": 339, "CH-US": 403, "CH-CA": 561},
    "PN": {"KFL-US": 276, "FL-US": 308, "FL-CA": 340, "CH-US": 404, "CH-CA": 562},
    "PQ": {"KFL-US": 277, "FL-US": 309, "FL-CA": 341, "CH-US": 405, "CH-CA": 563},
    "PS": {"KFL-US": 278, "FL-US": 310, "FL-CA": 342, "CH-US": 406, "CH-CA": 564},
    "PU": {"KFL-US": 279, "FL-US": 311, "FL-CA": 343, "CH-US": 407, "CH-CA": 565},
    "PW": {"KFL-US": 280, "FL-US": 312, "FL-CA": 344, "CH-US": 408, "CH-CA": 566},
    "SN": {"KFL-US": 281, "FL-US": 313, "FL-CA": 345, "CH-US": 409, "CH-CA": 567},
    "SY": {"KFL-US": 282, "FL-US": 314, "FL-CA": 346, "CH-US": 410, "CH-CA": 568},
    "TB": {"KFL-US": 283, "FL-US": 315, "FL-CA": 347, "CH-US": 411, "CH-CA": 569},
    "TN": {"KFL-US": 284, "FL-US": 316, "FL-CA": 348, "CH-US": 412, "CH-CA": 570},
    "TS": {"KFL-US": 285, "FL-US": 317, "FL-CA": 349, "CH-US": 413, "CH-CA": 571},
    "TW": {"KFL-US": 286, "FL-US": 318, "FL-CA": 350, "CH-US": 414, "CH-CA": 572},
    "U": {"KFL-US": 287, "FL-US": 319, "FL-CA": 351, "CH-US": 415, "CH-CA": 573},
    "UC": {"KFL-US": 288, "FL-US": 320, "FL-CA": 352, "CH-US": 416, "CH-CA": 574},
    "US": {"KFL-US": 289, "FL-US": 321, "FL-CA": 353, "CH-US": 417, "CH-CA": 575},
    "WD": {"KFL-US": 290, "FL-US": 322, "FL-CA": 354, "CH-US": 418, "CH-CA": 576},
    "WI": {"KFL-US": 291, "FL-US": 323, "FL-CA": 355, "CH-US": 419, "CH-CA": 577},
    "WO": {"KFL-US": 292, "FL-US": 324, "FL-CA": 356, "CH-US": 420, "CH-CA": 578},
    "WT": {"KFL-US": 293, "FL-US": 325, "FL-CA": 357, "CH-US": 421, "CH-CA": 579},
    "XX": {"FL-US": 762},
}
# Store reasons of one organisation, by the three digits that their text begins with.
STORE_REASON_ORG = "FL-US"
STORE_REASON_NUMBERS = {
    "501": 763, "502": 764, "503": 765, "504": 766, "505": 767, "506": 768, "507": 769, "508": 770,
    "509": 771, "510": 772, "511": 773, "512": 774, "513": 775, "514": 776, "515": 777, "521": 778,
    "522": 779, "523": 780, "525": 781, "526": 782, "527": 783, "529": 784, "534": 785, "539": 786,
    "999": 787,
}
# This text has a code and no number.
UNNUMBERED_REASON = "WRONG COLOR"


def lookup(c: Column | str, table: dict, default: Column | None = None) -> Column:
    """Value of a fixed table by key; ``default`` (or null) where the key is missing."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.element_at(pairs, col(c))
    return found if default is None else F.coalesce(found, default)


def status_number(c: Column | str) -> Column:
    return col(c).try_cast("int")


def company_number(org: Column | str) -> Column:
    return lookup(F.trim(col(org)), COMPANY_NUMBERS)


def order_status(status: Column | str, description: Column | str) -> Column:
    return lookup(status_number(status), ORDER_STATUS, F.upper(col(description)))


def mart_order_status(status: Column | str, description: Column | str, fraud_failed: Column | str) -> Column:
    """As ``order_status``; a failed fraud check outranks all but SUBMITTED."""
    number = status_number(status)
    return (F.when(number.isin(1000, 1500), F.lit("SUBMITTED"))
            .when(col(fraud_failed) == 1, F.lit("FRAUD_CHECK_FAILED"))
            .otherwise(lookup(number, MART_ORDER_STATUS, F.upper(col(description)))))


def return_status(status: Column | str, description: Column | str) -> Column:
    return lookup(status_number(status), RETURN_STATUS, F.upper(F.trim(col(description))))


def fulfilment_type(method: Column | str, table: dict = FULFILMENT_TYPE) -> Column:
    method = F.upper(F.trim(col(method)))
    return lookup(method, table, method)


def location_kind(kind: Column | str) -> Column:
    kind = F.upper(col(kind))
    return lookup(kind, LOCATION_KIND, kind)


def fulfilment_centre(kind: Column | str, city: Column | str) -> Column:
    kind, city = F.upper(col(kind)), F.upper(F.trim(col(city)))
    return F.when(kind == "DC", lookup(city, CENTRE_CITY, F.lit("DC"))).otherwise(lookup(kind, CENTRE_KIND))


def return_place(kind: Column | str, city: Column | str) -> Column:
    kind, city = F.upper(col(kind)), F.upper(F.trim(col(city)))
    return F.when(kind == "STORE", F.lit("XSTORE")).when(kind == "DC", lookup(city, RETURN_CITY, city))


def tender_type(payment_type: Column | str, table: dict = TENDER_TYPE) -> Column:
    payment_type = col(payment_type)
    return lookup(payment_type, table, F.upper(payment_type))


def funding_source(payment_type: Column | str) -> Column:
    return lookup(payment_type, FUNDING_SOURCE, F.upper(col(payment_type)))


def card_class(card_type: Column | str) -> Column:
    return lookup(F.upper(col(card_type)), CARD_CLASS, F.lit("9"))


def tender_movement(transaction_type: Column | str) -> Column:
    return lookup(transaction_type, TENDER_MOVEMENT, F.upper(col(transaction_type)))


def message_type(order_type: Column | str, order_id: Column | str, release_id: Column | str) -> Column:
    """Returns and exchanges by the id's suffix; orders turn into consignments at release."""
    is_return = F.lower(col(order_type)) == "return"
    order_id = F.lower(col(order_id))
    return (F.when(is_return & order_id.like("%-e_"), "EXCHANGE")
            .when(is_return & order_id.like("%-r_"), "RETURN")
            .when(~is_return & col(release_id).isNull(), "ORDER")
            .when(~is_return, "CONSIGNMENT"))


def product_banner(org: Column | str) -> Column:
    """Product-master banner of an organisation; the join key is built before the join."""
    return F.when(col(org).isin(*CANADA_ORGS), F.lit(CANADA_BANNER)).otherwise(F.lit(US_BANNER))


def published_channel(channel: Column | str, names: dict[str, str]) -> Column:
    """Selling channel such as ``FL-US - ShipToHome`` as the published name; others unchanged."""
    channel = col(channel)
    return lookup(F.upper(F.replace(channel, F.lit(" "), F.lit(""))), names, channel)


def return_reason_code(org: Column | str, reason: Column | str) -> Column:
    org, reason = F.trim(col(org)), F.upper(col(reason))
    texts = {text: code for code, group in RETURN_REASONS.items() for text in group}
    store = F.regexp_extract(reason, "^([0-9]{3})-", 1)
    known = store.isin(*STORE_REASON_NUMBERS)
    return F.when(org.isin(*REASON_NUMBERS["BW"]),
                  lookup(reason, texts, F.when((org == STORE_REASON_ORG) & known, store)))


def return_reason_number(org: Column | str, reason: Column | str) -> Column:
    org, reason = F.trim(col(org)), F.upper(col(reason))
    code = return_reason_code(org, reason)
    numbers = {f"{code} {o}": n for code, by_org in REASON_NUMBERS.items() for o, n in by_org.items()}
    numbered = F.when(reason != UNNUMBERED_REASON, lookup(F.concat_ws(" ", code, org), numbers))
    return F.coalesce(numbered, lookup(code, STORE_REASON_NUMBERS))
