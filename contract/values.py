"""Fixed values that the reference SQL is written with, apart from those of the library."""

AD_PLATFORMS = ['criteo', 'google', 'meta', 'rtbhouse', 'tiktok']
ACTIVITY_TYPES = ['profile_change', 'transaction', 'session']
CURRENCIES = ['USD', 'EUR', 'GBP', 'CAD']
CUSTOMER_STATES = ['New Customer', 'Repeat Customer', 'Loyal Customer', 'Premium Customer']
DEVICES = ['desktop', 'mobile', 'tablet', 'unknown']
EVENTS = ['page_view', 'add_to_cart', 'purchase', 'begin_checkout', 'view_item', 'remove_from_cart']
LISTING_CONDITIONS = ['New with tags', 'New with box', 'New without tags']
LISTING_GENDERS = ['mens', 'womens', 'unisex', 'kids']
RETURN_STATUSES = ['Refund', 'Exchange']
TRAFFIC_MEDIUMS = ['organic', 'paid', 'email', 'social', 'direct', 'referral', 'cpc', 'display', '(none)', 'crm',
 'affiliate', 'influencer', 'cpm', 'organic_social', 'paid_social', 'comparison', 'cpv']
USER_GENDERS = ['M', 'F', 'Non-binary', 'Unknown']
AD_CHANNELS = {'Search': ['google ads', 'bing ads', 'yahoo ads'],
 'Paid Social': ['facebook', 'instagram', 'twitter', 'linkedin', 'tiktok', 'snapchat',
                 'pinterest'],
 'DSP': ['google display', 'programmatic', 'dsp', 'demand side platform'],
 'Video': ['youtube', 'video', 'connected tv', 'ctv'],
 'Retail Media': ['amazon', 'walmart', 'marketplace'],
 'Email': ['email', 'newsletter']}
BROWSERS = ((['chrome'], 'Chrome'), (['safari'], 'Safari'), (['firefox'], 'Firefox'), (['edge'], 'Edge'),
 (['internet explorer', 'ie'], 'Internet Explorer'), (['opera'], 'Opera'))
DEVICE_TYPES = {'Mobile': ['mobile', 'smartphone', 'phone'],
 'Tablet': ['tablet', 'ipad'],
 'Desktop': ['desktop', 'computer', 'pc', 'mac'],
 'Connected TV': ['tv', 'smart tv', 'connected tv']}
MEDIUM_CATEGORIES = {'Organic': ['organic'],
 'Paid Search': ['cpc', 'ppc', 'paid'],
 'Social': ['social', 'social-network', 'social-media'],
 'Email': ['email', 'newsletter'],
 'Display': ['display', 'banner'],
 'Referral': ['affiliate', 'referral'],
 'Video': ['video'],
 'Direct': ['(none)', 'direct'],
 'Push': ['push', 'notification'],
 'SMS': ['sms', 'text']}
OPERATING_SYSTEMS = ((['windows'], 'Windows'), (['mac', 'osx'], 'macOS'), (['ios'], 'iOS'),
 (['android'], 'Android'), (['linux'], 'Linux'))
TRAFFIC_SOURCES = {'google': ['google', 'youtube.com', 'youtube', 'google.com'],
 'meta': ['meta', 'facebook', 'facebook.com', 'l.facebook.com', 'lm.facebook.com',
          'm.facebook.com', 'instagram', 'instagram.com', 'l.instagram.com'],
 'tiktok': ['tiktok', 'tiktok.com'],
 'rtbhouse': ['rtbhouse', 'tradedoubler', 'awin', 'tradedesk'],
 'criteo': ['criteo', 'dv360', 'taboola'],
 'twitter': ['twitter', 'twitter.com']}
GENDER_WORDS = {'womens': ['women', 'womens', "woman's", 'female', 'ladies'],
 'mens': ['men', 'mens', "man's", 'male'],
 'unisex': ['unisex'],
 'kids': ['kids', 'child', 'children', 'boys', 'girls', 'boy', 'girl', 'youth', 'junior']}
KNOWN_BRANDS = ['adidas', 'reebok', 'nike', 'puma', 'asics', 'new balance', 'converse', 'vans', 'under armour',
 'levis', 'jack & jones', 'national geographic', 'u.s. polo assn.', 'pierre cardin', 'hummel',
 'calvin klein', 'swarovski']
LEADING_WORDS = ['new', 'latest', 'original', 'authentic', 'genuine', 'mens', 'women', 'womens', 'kids',
 'unisex', 'ladies', 'boys', 'girls', 'child', 'children', 'male', 'female']
INJECTION_PATTERNS = ['(?i)(SELECT|DROP|DELETE|INSERT|UPDATE|UNION|ALTER|CREATE|TRUNCATE|EXEC|EXECUTE)',
 '(<script|javascript:|onload=|onerror=|xp_|sp_)', "'", '"', ';', '<', '>', '(--|/\\*|\\*/)']
# Agents of the page requests that the agent rules are tried on.
AGENT_BROWSERS = [
    "Chrome/120 Safari/537", "Version/17 Safari/605", "Firefox/121", "Edge/18", "Internet Explorer 11",
    "MSIE 10", "Opera/9", "curl/8", "Edge/18 MSIE 7", "Chrome/119 Edge/119",
]
AGENT_SYSTEMS = [
    "Windows NT 10", "Macintosh; Mac OS", "Linux x86", "Android 14", "iOS 17", "iPhone", "iPad",
    "CrOS", "Linux; Android 13", "iPhone OS like Mac OS",
]
