"""Code lists of the payment domain.

Fixed values: everything in this module has to equal what card schemes, processors
and the dispute desk use, so it is stated as it is.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class House:
    """What a company fills in for its own case files: partner ids and names."""

    top_up_partners: tuple[int, ...] = ()
    ten_day_partners: tuple[int, ...] = ()
    liable_service_partners: tuple[int, ...] = ()
    executing_partners: tuple[int, ...] = ()
    us_broker: str = "us-broker"
    deciding_application: str = "decision-engine"
    mass_closing_tag: str = "mass-closed"


#: The partners of the tests and of the registered queries.
EXAMPLE = House(top_up_partners=(1, 15), ten_day_partners=(40,), liable_service_partners=(38, 40, 67), executing_partners=(23, 40, 67))

PROCESSOR_IDS = {"ecp": 3, "paysafe": 5, "worldline": 7, "safecharge": 8}

PROCESSING_FEE = {"ecp": 0.25, "paysafe": 0.2, "worldline": 0.2, "safecharge": 0.2}

DEFAULT_COST_SHARE = 0.0205

# Reason codes of the authentication response.
AUTH_REASONS = {
    "01": "Card authentication failed",
    "02": "Unknown Device",
    "03": "Unsupported Device",
    "04": "Exceeds authentication frequency limit",
    "05": "Expired card",
    "06": "Invalid card number",
    "07": "Invalid transaction",
    "08": "No Card record",
    "09": "Security failure",
    "10": "Stolen card",
    "11": "Suspected fraud",
    "12": "Transaction not permitted to cardholder",
    "13": "Cardholder not enrolled in service",
    "14": "Transaction timed out at the ACS",
    "15": "Low confidence",
    "16": "Medium confidence",
    "17": "High confidence",
    "18": "Very High confidence",
    "19": "Exceeds ACS maximum challenges",
    "20": "Non-Payment transaction not supported",
    "21": "3RI transaction not supported",
    "22": "ACS technical issue",
    "23": "Decoupled Authentication required by ACS but not requested by 3DS Requestor",
    "24": "3DS Requestor Decoupled Max Expiry Time exceeded",
    "25": "Decoupled Authentication was provided insufficient time to authenticate cardholder. "
          "ACS will not make attempt",
    "26": "Authentication attempted but not performed by the cardholder",
}
# Ranges of two-digit codes: (first, last, text).
AUTH_REASON_RANGES = [
    (27, 79, "Reserved for EMVCo future use (values invalid until defined by EMVCo)"),
    (80, 99, "Reserved for DS use"),
]

# Card brands priced as corporate cards.
CORPORATE_BRANDS = [
    "prepaid platinum", "business", "platinum", "infinite", "world for business",
    "corporate/business prepaid", "visa corporate", "signature", "gold", "corporate",
    "mc comm/corp", "platinium", "commercial/business", "corporate world elite",
    "commercial/corp", "corporate immediate debit", "corporate world", "world embossed",
    "mc world emb",
]

DOMESTIC_COUNTRIES = ["GB"]
EEA_COUNTRIES = [
    "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "GR", "ES", "FR", "HR", "IT", "CY", "LV",
    "LT", "LU", "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI", "SK", "FI", "SE", "CH", "NO",
]

# Spellings of the acquirer reference number in processor reports.
ARN_KEYS = ["arn", "ARN", "Acquirer ref number", "Acquirer Ref Number"]

# Address check answers, by processor.
AVS_MATCH = {
    "ecp": ["5A", "5B", "5D", "5F", "5M", "5P", "5W", "5X", "5Y", "5Z"],
    "paysafe": ["MATCH", "MATCH_ADDRESS_ONLY", "MATCH_ZIP_ONLY"],
    "safecharge": ["A", "B", "D", "F", "M", "P", "W", "X", "Y", "Z"],
}
AVS_NOT_SENT = {"ecp": ["5G", "5R", "5U"], "safecharge": ["R", "G", "U"]}

# Electronic commerce indicators that shift liability.
LIABILITY_SHIFT_ECI = ["1", "2", "5", "6", "01", "02", "05", "06"]

# Warning codes of the first processor: (code, type, description).
ECP_WARNINGS = [
    ("0", "0", "Card reported lost"),
    ("1", "1", "Stolen"),
    ("3", "3", "Fraudulent application"),
    ("4", "4", "Counterfeit card fraud"),
    ("6", "6", "Card not present fraud"),
    ("NaN", "D", "Manipulation of Account Holder"),
]
# Warning names of the second processor: (name, type, description).
SAFECHARGE_WARNINGS = [
    ("Lost Fraud", "0", "Card reported lost"),
    ("Stolen Fraud", "1", "Stolen"),
    ("Never Received Issue", "2", "Never Received Issue"),
    ("Fraudulent Application", "3", "Fraudulent application"),
    ("Counterfeit Card Fraud", "4", "Counterfeit card fraud"),
    ("Card Not Present Fraud", "6", "Card not present fraud"),
    ("Processing Error", "A", "Incorrect Processing"),
    ("Account Takeover Fraud", "B", "Account takeover fraud"),
    ("Unknown", "Unknown", "Unknown"),
]
# Warnings told apart by the first digit of the reference number:
# (processor, warning, first digits, type, description).
SCHEME_WARNINGS = [
    ("ecp", "5", "72", "V5", "Miscellaneous"),
    ("ecp", "5", "80", "M5", "Account takeover fraud"),
    ("safecharge", "Other", "72", "V5", "Miscellaneous"),
    ("safecharge", "Account Takeover Fraud", "80", "M5", "Account takeover fraud"),
]

# Reason codes taken as identity disputes.
IDENTITY_REASONS = ["10.4", "4837", "4849", "4808", "11.3", "10.5", "4840"]
TURNKEY_FRAUD_REASONS = ["11.3", "4808"]
REASON_TEXT = {
    "10.5": "Visa Fraud Monitoring Program",
    "4870": "Chip Liability Shift",
    "4871": "Chip/PIN Liability Shift",
}
SKIPPED_REASONS = ["2700"]
APPROVED_STATUSES = [2, 13, 15, 9]
REFUNDED_STATUSES = [13, 15]
BINBASE_VERSION = 14

# Block explorers: coin to link prefix.
EXPLORERS = {
    "AAVE": "https://etherscan.io/tx/",
    "ADA": "https://blockchair.com/cardano/transaction/",
    "ALGO": "https://algoexplorer.io/tx/",
    "APE": "https://etherscan.io/tx/",
    "ATOM": "https://atom.tokenview.com/en/tx/",
    "AVAX": "https://explorer-xp.avax.network/tx/",
    "AVAX-C": "https://snowtrace.io/tx/",
    "BABYDOGE": "https://bscscan.com/txs?a=",
    "BAT": "https://etherscan.io/tx/",
    "BSV": "https://blockchair.com/bitcoin-sv/address/",
    "BTC": "https://blockchair.com/bitcoin/address/",
    "BCH": "https://blockchair.com/bitcoin-cash/address/",
    "BUSD": "https://etherscan.io/tx/",
    "BUSD-SC": "https://bscscan.com/tx/",
    "CAKE": "https://bscscan.com/tx/",
    "CEL": "https://etherscan.io/tx/",
    "COTI": "https://explorer.coti.io/",
    "CRO-ERC20": "https://etherscan.io/tx/",
    "CUSD": "https://explorer.celo.org/tx/",
    "DAI": "https://etherscan.io/tx/",
    "DASH": "https://blockchair.com/dash/address/",
    "DGB": "https://dgb.tokenview.com/en/address/",
    "DOGE": "https://blockchair.com/dogecoin/address/",
    "DOT": "https://blockchair.com/polkadot/address/",
    "ELON": "https://etherscan.io/tx/",
    "EOS": "https://bloks.io/transaction/",
    "ETH": "https://etherscan.io/tx/",
    "FIL": "https://filfox.info/en/address/",
    "GALA": "https://etherscan.io/tx/",
    "HBAR": "https://app.dragonglass.me/hedera/transactions/",
    "ICX": "https://tracker.icon.foundation/transaction/",
    "KAI": "https://explorer.kardiachain.io/tx/",
    "KAVA": "https://www.mintscan.io/kava/txs/",
    "KCS": "https://etherscan.io/tx/",
    "KLV": "https://tronscan.org/#/transaction/",
    "KSM": "https://kusama.polkastats.io/extrinsic/",
    "LINK": "https://etherscan.io/tx/",
    "LTC": "https://blockchair.com/litecoin/address/",
    "LUNA": "https://finder.terra.money/mainnet/address/",
    "MATIC": "https://polygonscan.com/tx/",
    "NANO": "https://nanolooker.com/block/",
    "NEAR": "https://nearblocks.io/txns/",
    "ONE": "https://explorer.harmony.one/tx/",
    "OSMO": "https://www.mintscan.io/osmosis/account/",
    "QTUM": "https://explorer.qtum.org/address/",
    "RVN": "https://rvn.tokenview.com/en/address/",
    "SAND": "https://etherscan.io/tx/",
    "SHIB": "https://etherscan.io/tx/",
    "SOL": "https://solscan.io/tx/",
    "TRX": "https://tronscan.org/#/transaction/",
    "UNI": "https://etherscan.io/tx/",
    "USDC": "https://etherscan.io/tx/",
    "USDC-TRC20": "https://tronscan.org/#/transaction/",
    "USDK": "https://etherscan.io/tx/",
    "USDT": "https://etherscan.io/tx/",
    "USDT-TRC20": "https://tronscan.org/#/transaction/",
    "VET": "https://explorer.vtho.net/#/transactions/",
    "WAXP": "https://wax.bloks.io/transaction/",
    "XAUT": "https://etherscan.io/tx/",
    "XDC": "https://explorer.xinfin.network/txs/",
    "XEM": "https://explorer.nemtool.com/#/s_tx?hash=",
    "XLM": "https://stellarchain.io/tx/",
    "XRP": "https://blockexplorer.one/xrp/mainnet/tx/",
    "XTZ": "https://tzstats.com/",
    "HTR": "https://explorer.hathor.network/transaction/",
}
EXPLORER_BNB = "https://explorer.binance.org/tx/"
EXPLORER_BSC = "https://bscscan.com/tx/"
# Coins whose link ends in the address, and coins whose hash is shown with 0x.
ADDRESS_COINS = ["BABYDOGE", "BCH", "BSV", "BTC", "DASH", "DGB", "DOGE", "DOT", "FIL", "LTC", "LUNA", "OSMO",
                 "QTUM", "RVN"]
HEX_COINS = ["CEL", "CRO-ERC20", "DAI", "LINK", "UNI"]
