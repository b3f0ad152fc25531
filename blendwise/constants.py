"""Fixed values of the studied report models.

These must equal the models' literals for identical results; every operator
takes them as overridable arguments whose defaults come from here.
"""

# ----------------------------------------------------------------------------
# Fixed values (as the studied models state them)
# ----------------------------------------------------------------------------

# Granularities, in the order the models list them.
GRAINS = ("day", "week", "month", "quarter", "year")

# Sentinel labels.
NOT_SET = "(not set)"
NOT_SET_BARE = "not set"
OTHER = "Other"
OTHERS = "Others"
NOT_PAID = "Not Paid"
STORE_CHANNEL = "Shopify"
WEB_CHANNEL = "GA4"

# Linear attribution: model type and look-back window in days.
LINEAR_MODEL = "ORDERS_LINEAR_ALL"
LOOKBACK_DAYS = 28

# Attribution sources: (source, channel, needs a non-blank campaign id).
ATTRIBUTION_CHANNELS_TWO = (("facebook-ads", "Facebook", True), ("google-ads", "Google Ads", False))
ATTRIBUTION_CHANNELS_THREE = (("facebook-ads", "Facebook", True), ("applovin", "App Lovin", True),
                              ("google-ads", "Google Ads", False))

# Web analytics source / medium to channel.
WEB_MEDIUM_CHANNELS = (("facebook / cpc", "Facebook"), ("google / cpc", "Google Ads"))

# Fee allocation.
FEE_UPLIFT = 1.02565
FEE_POOL_BEFORE = 10000.0
FEE_POOL_AFTER = 17000.0
FEE_POOL_SWITCH = "2025-08-01"
FEE_CHANNEL = "Google Ads"
FEE_MARKET = "US"
FEE_CAMPAIGN_TYPES = ("Demand Gen", "Youtube")
FEE_IMAGE_PATTERN = "image"
FEE_BREAKDOWN_LABELS = ("DG Video", "Other")
FEE_GRAIN_FACTORS = (("week", 7), ("quarter", 3), ("year", 12))

# Spend splits and cut-over.
SOCIAL_RETENTION_PATTERN = "react"
SEARCH_BRAND_PATTERN = "brand"
BRAND_ACQUISITION_SHARE = 0.34
AFFILIATE_SWITCH_DATE = "2025-04-28"
ACQUISITION_TYPE_PATTERNS = ("prospecting", "retargeting")

# Web sessions adjustment factor.
SESSION_FACTOR = 0.8

# App installs: self-attributing sources with their channels, and the SKAN offset channel.
APP_CHANNELS = (("Facebook Ads", "Meta"), ("googleadwords_int", "Google Ads"),
                ("tiktokglobal_int", "Tiktok Ads"))
SKAN_OFFSET_CHANNEL = "af_app_invites"
APP_WEEK_START = "sunday"

# Touch-export text repairs.
CONTENT_REPLACEMENTS = (("A SC", "A+SC"), ("USA CAN", "USA+CAN"), ("UnsubscribedEmail SMS", "UnsubscribedEmail+SMS"))
UTM_REPLACEMENTS = (("A SC", "A+SC"),)
TERM_CUT = "- Copy"

# Touch campaign-type keywords, first match wins (names of the matched fields in comments).
CAMPAIGN_TYPE_KEYWORDS = (
    ("Amazon", "amazon"),                    # google or bing campaign
    ("Demand Gen", "demand"),                # google campaign or utm
    ("Youtube", "YT", "youtube"),            # google campaign, or channel
    ("Shopping - Brand", "Shopping", "Brand"),
    ("Shopping - Non Brand", "Shopping", "Brand"),
    ("PMax", "Performance Max", "PMax"),
    ("Non Brand", "NB"),
    ("Branded", "Brand"),
    ("Prospecting", "Prospect", "Interest"),  # utm
    ("Retargeting", "Retarget"),              # utm
)
