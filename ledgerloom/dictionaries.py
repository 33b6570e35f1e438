"""They must equal the source system's for right results."""

# Words that stand for "no value" (after strip and lower case).
NULL_TOKENS = (
    "", "na", "n/a", "n.a.", "none", "null", "nil", "-", "--", ".", "not available", "notavailable",
    "not applicable", "not provided", "not disclosed", "no", "no website", "tbd", "xxx", "0",
)

# Display form of legal suffixes.
SUFFIX_DISPLAY = {
    "private limited": "Private Limited", "limited": "Limited", "llp": "LLP",
    "opc": "OPC", "pvt": "Private", "ltd": "Limited",
}

# Rewrites of the name key, applied in this order.
KEY_SUFFIX_REWRITES = (
    (r"\bp\s*v\s*t\b\.?", "private"),
    (r"\bpri?vate\b", "private"),
    (r"\bl\s*t\s*d\b\.?", "limited"),
    (r"\blimited\b", "limited"),
    (r"\bl\.?l\.?p\.?\b", "llp"),
    (r"\bo\.?p\.?c\.?\b", "opc"),
    (r"\bincorporated\b|\binc\b", "inc"),
    (r"\bcorporation\b|\bcorp\b", "corp"),
    (r"\bcompany\b|\bco\b", "co"),
)

# Hosts shared by many companies; their sub-domains count too.
GENERIC_DOMAINS = (
    "google.com", "google.co.in", "g.co", "sites.google.com", "play.google.com",
    "docs.google.com", "drive.google.com", "forms.gle", "goo.gl",
    "indiamart.com", "justdial.com", "tradeindia.com", "exportersindia.com",
    "facebook.com", "fb.com", "m.facebook.com", "instagram.com", "linkedin.com",
    "twitter.com", "x.com", "youtube.com", "youtu.be", "whatsapp.com", "wa.me",
    "t.me", "telegram.me", "pinterest.com", "threads.net", "linktr.ee",
    "wordpress.com", "wordpress.org", "blogspot.com", "blogspot.in",
    "wixsite.com", "wix.com", "weebly.com", "godaddy.com", "squarespace.com",
    "shopify.com", "myshopify.com", "tumblr.com", "medium.com", "notion.site",
    "canva.com", "behance.net", "github.io", "github.com", "gitlab.com",
    "amazon.in", "amazon.com", "flipkart.com", "meesho.com", "etsy.com",
    "gmail.com", "yahoo.com", "yahoo.in", "hotmail.com", "outlook.com",
    "rediffmail.com", "icloud.com", "protonmail.com", "example.com",
    "apps.apple.com", "play.google.co.in", "startupindia.gov.in",
    "zaubacorp.com", "tofler.in", "thecompanycheck.com", "falconebiz.com",
    "instafinancials.com", "quickcompany.in", "company360.in", "corpwiki.in",
    "companycheck.in", "mca.gov.in", "opencorporates.com", "dnb.co.in",
    "indiafilings.com", "vakilsearch.com", "cleartax.in", "corpbiz.io",
    "setindiabiz.com", "legalraasta.com", "indiacompanyregistration.com",
    "razorpay.com", "instamojo.com", "dukaan.io", "mydukaan.io", "bikayi.com",
    "shopdeck.com", "digital.startupindia.gov.in", "about.me", "carrd.co",
    "bit.ly", "tinyurl.com", "rebrand.ly", "cutt.ly", "rb.gy", "lnkd.in",
    "shorturl.at", "t.co", "ow.ly", "surl.li",
    "nowebsite.com", "noweb.com", "notavailable.com", "dummy.com", "test.com",
    "website.com", "none.com", "example.org", "example.net", "abc.com",
    "xyz.com", "domain.com", "yourwebsite.com", "mywebsite.com", "na.com",
    "comingsoon.com", "underconstruction.com",
)

# Name keys too general to link two records.
GENERIC_NAME_KEYS = (
    "abc", "xyz", "test", "testing", "demo", "sample", "dummy", "asdf",
    "na", "company", "startup", "my company", "new company", "private limited",
    "limited", "llp", "opc", "none", "nil", "unknown", "individual", "self",
    "proprietor", "sole proprietor", "not applicable", "aaa", "aaaa", "aaaaa",
)

# Other spellings of states.
STATE_ALIASES = {
    "orissa": "odisha",
    "pondicherry": "puducherry",
    "pondichery": "puducherry",
    "uttaranchal": "uttarakhand",
    "new delhi": "delhi",
    "nct of delhi": "delhi",
    "delhi ncr": "delhi",
    "national capital territory of delhi": "delhi",
    "jammu & kashmir": "jammu and kashmir",
    "j&k": "jammu and kashmir",
    "andaman & nicobar islands": "andaman and nicobar islands",
    "andaman and nicobar": "andaman and nicobar islands",
    "dadra & nagar haveli": "dadra and nagar haveli and daman and diu",
    "daman & diu": "dadra and nagar haveli and daman and diu",
    "dadra and nagar haveli": "dadra and nagar haveli and daman and diu",
    "daman and diu": "dadra and nagar haveli and daman and diu",
    "tamilnadu": "tamil nadu",
    "chattisgarh": "chhattisgarh",
    "chhatisgarh": "chhattisgarh",
    "telengana": "telangana",
}

# Other spellings of cities.
CITY_ALIASES = {
    "bangalore": "bengaluru",
    "bangaluru": "bengaluru",
    "gurgaon": "gurugram",
    "bombay": "mumbai",
    "calcutta": "kolkata",
    "madras": "chennai",
    "trivandrum": "thiruvananthapuram",
    "cochin": "kochi",
    "mysore": "mysuru",
    "mangalore": "mangaluru",
    "baroda": "vadodara",
    "poona": "pune",
    "vizag": "visakhapatnam",
    "pondicherry": "puducherry",
    "gauhati": "guwahati",
    "benares": "varanasi",
    "banaras": "varanasi",
    "allahabad": "prayagraj",
    "gurgao": "gurugram",
}

# Words kept in lower case inside a place name.
SMALL_WORDS = ("and", "of", "the")

# Technologies by the text that gives them away, in this order.
TECHNOLOGIES = (
    ("WordPress", "cms", ("/wp-content/", "/wp-includes/", "wp-json", "wp-emoji")),
    ("Shopify", "ecommerce", ("cdn.shopify.com", "/cdn/shop/", "shopify.theme", "x-shopify", "myshopify.com")),
    ("Wix", "cms", ("static.wixstatic.com", "wix.com", "_wixcssinjover", "wixsite.com")),
    ("Squarespace", "cms", ("static1.squarespace.com", "squarespace.com", "static.squarespace")),
    ("Webflow", "cms", ("assets.website-files.com", "assets-global.website-files.com", "webflow.io", "wf-")),
    ("Drupal", "cms", ("/sites/default/files", "drupal-settings-json", "drupal.js")),
    ("Next.js", "js-framework", ("__next_data__", "/_next/static", "/_next/", "next/dist")),
    ("React", "js-framework", ("data-reactroot", "react-dom", "_reactlistening", "__reactcontainer", "react.production.min")),
    ("Vue.js", "js-framework", ("data-v-", "__vue__", "vue.runtime", "vue.min.js")),
    ("Angular", "js-framework", ("ng-version", "ng-app", "angular.min.js", "_ngcontent")),
    ("Nuxt.js", "js-framework", ("__nuxt__", "/_nuxt/")),
    ("Gatsby", "js-framework", ("___gatsby", "gatsby-", "/page-data/")),
    ("Laravel", "backend", ("laravel_session", "xsrf-token", "/vendor/laravel", "laravel")),
    ("Django", "backend", ("csrfmiddlewaretoken", "__admin_media_prefix__")),
    ("Ruby on Rails", "backend", ("csrf-param", "rails-", "data-turbo")),
    ("Cloudflare", "cdn", ("cdn-cgi/", "__cf_bm", "cf-ray", "email-protection", "challenge-platform", "cloudflareinsights")),
    ("Google Analytics", "analytics", ("googletagmanager.com/gtag/js", "google-analytics.com/analytics.js", "googleanalyticsobject", "ga('create", "gtag(")),
    ("Google Tag Manager", "analytics", ("googletagmanager.com/gtm.js", "gtm-")),
    ("Facebook Pixel", "analytics", ("connect.facebook.net", "fbq(", "fbevents.js")),
    ("HubSpot", "marketing", ("js.hs-scripts.com", "hs-analytics", "hubspot")),
    ("Hotjar", "analytics", ("static.hotjar.com", "hotjar")),
    ("Bootstrap", "ui", ("bootstrap.min.css", "bootstrap.bundle", 'class="container')),
    ("jQuery", "js-library", ("jquery.min.js", "jquery-", "/jquery.js")),
    ("Elementor", "cms", ("elementor-", "/elementor/")),
)

# Hosting providers by the text that gives them away; the first that is found counts.
HOSTING_SIGNS = (
    ("cloudflare", "Cloudflare"), ("amazonaws", "Amazon AWS"), ("aws", "Amazon AWS"), ("1e100.net", "Google"), ("googleusercontent", "Google Cloud"),
    ("google", "Google"), ("azure", "Microsoft Azure"), ("windows.net", "Microsoft Azure"), ("netlify", "Netlify"), ("vercel", "Vercel"),
    ("github", "GitHub Pages"), ("shopify", "Shopify"), ("wixdns", "Wix"), ("wix.com", "Wix"), ("squarespace", "Squarespace"), ("hostinger", "Hostinger"),
    ("secureserver.net", "GoDaddy"), ("domaincontrol.com", "GoDaddy"), ("bluehost", "Bluehost"), ("hostgator", "HostGator"), ("websitewelcome", "HostGator"),
    ("bigrock", "BigRock"), ("hostwinds", "Hostwinds"), ("digitalocean", "DigitalOcean"), ("ns.hostgpu", "Hosting.com"), ("namecheap", "Namecheap"),
    ("registrar-servers.com", "Namecheap"), ("fastly", "Fastly"), ("akamai", "Akamai"),
)
GITHUB_PAGES_IPS = ("185.199.108.153", "185.199.109.153", "185.199.110.153", "185.199.111.153")

# E-mail addresses that are no contacts.
EMAIL_JUNK = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", "@2x", "@3x")
EMAIL_JUNK_DOMAINS = (
    "example.com", "example.org", "domain.com", "email.com", "yourdomain.com", "sentry.io", "wix.com", "wixpress.com",
    "sentry-next.wixpress.com", "godaddy.com", "schema.org", "w3.org", "png", "jpg",
)

# Social platforms by host, links that only share, and paths that are no profile.
SOCIAL_HOSTS = {
    "linkedin": ("linkedin.com",), "twitter": ("twitter.com", "x.com"), "instagram": ("instagram.com",),
    "facebook": ("facebook.com", "fb.com"), "youtube": ("youtube.com", "youtu.be"), "github": ("github.com",),
}
SOCIAL_SKIP = ("/share", "/sharer", "/intent", "sharer.php", "/tr?", "plugins/")
SOCIAL_NO_PROFILE = ("", "/", "/watch", "/home", "/login", "/signup", "/feed", "/results", "/hashtag", "/explore", "/about", "/help")

# Page types by words in the link.
PAGE_WORDS = {
    "about": ("about", "who-we-are", "our-story", "company"),
    "contact": ("contact", "reach-us", "get-in-touch", "connect"),
    "team": ("team", "people", "leadership", "founders", "our-team"),
    "careers": ("career", "jobs", "join-us", "hiring", "work-with-us"),
    "privacy": ("privacy",),
    "terms": ("terms", "tos", "terms-of-service", "terms-and-conditions"),
    "blog": ("blog", "news", "insights", "articles"),
}

# Patterns of hosts, registration numbers, phones, e-mail addresses, facts in text and analytics ids.
HOST_PATTERN = r"^(?=.{1,253}$)([a-z0-9]([a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}$"
CIN_PATTERN = r"^[LU]\d{5}[A-Z]{2}\d{4}[A-Z]{3}\d{6}$"
PHONE_PATTERN = r"(?:\+?91[\- ]?)?0?[6-9]\d{9}\b"
EMAIL_PATTERN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
FOUNDED_PATTERN = r"(?i)(?:founded|established|est\.?|since|inception|incorporated)[^0-9]{0,20}(19\d{2}|20\d{2})"
STAFF_PATTERN = r"(?i)(?:\d{1,3}(?:,\d{3})*|\d+)\s*\+?\s*(?:employees|team members|people|professionals)"
TEAM_OF_PATTERN = r"(?i)team of\s+(?:\d{1,3}(?:,\d{3})*|\d+)\+?"
ANALYTICS_ID_PATTERN = r"\b(?:UA-\d{4,}-\d+|G-[A-Z0-9]{6,}|GTM-[A-Z0-9]{4,})\b"

# Hosts of throw-away mailboxes, statuses that make an address useless, and addresses tried at every host.
DISPOSABLE_DOMAINS = (
    "mailinator.com", "10minutemail.com", "guerrillamail.com", "guerrillamail.info", "tempmail.com", "temp-mail.org", "trashmail.com", "yopmail.com", "getnada.com",
    "throwawaymail.com", "fakeinbox.com", "sharklasers.com", "maildrop.cc", "dispostable.com", "mailnesia.com", "mvrht.net", "spamgourmet.com",
    "tempinbox.com", "emailondeck.com", "mohmal.com", "moakt.com", "burnermail.io", "tempmailo.com", "1secmail.com", "tmpmail.org", "discard.email",
)
USELESS_STATUSES = ("invalid", "disposable")
PATTERN_LOCALS = ("info", "contact", "sales", "support", "hello")

# Words that are no keywords.
STOP_WORDS = "the a an and or for of to in on with your our we is are be by from at as it that this you they their his her its all can will more most best your you're company startup private limited llp india based services solutions".split()
