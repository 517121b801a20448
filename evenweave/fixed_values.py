"""Fixed values.

Everything here is a value the results depend on: category lists, weights, codes, prompt wording and
fallback wording of the example ad-copy data set. The operators take all of it as parameters; nothing
in ``operators/`` reads this module. Only ``example.py`` assembles these values into specs and tasks.
"""

# --- hierarchy: theme -> objects, in rank order -------------------------------------------------
THEME_OBJECTS = {
    "Food": ["Pizza", "Burger", "Coffee", "Sushi", "Salad", "Juice"],
    "Fashion": ["Bag", "Watch", "Shoes", "Jacket", "Dress", "Scarf"],
    "Tech": ["Phone", "Laptop", "Headphones", "Camera", "Tablet", "Speaker"],
    "Automotive": ["Car", "Motorcycle", "Truck", "SUV", "Scooter", "Helmet"],
    "Travel": ["Hotel", "Beach", "Resort", "Luggage", "Passport", "Mountain"],
    "Finance": ["Card", "Stocks", "Wallet", "Coins", "Bank", "Investment"],
    "Home": ["Sofa", "Lamp", "Blender", "Rug", "Pillow", "Clock"],
    "Gaming": ["Console", "Controller", "Headset", "Monitor", "Chair", "Keyboard"],
    "Education": ["Book", "Pen", "Backpack", "Notebook", "Calculator", "Globe"],
}

# --- per-object template: (emotion, sentiment, weight) ------------------------------------------
EMOTION_ORDER = ["Joy", "Anger", "Trust", "Excitement", "Fear"]
SENTIMENT_ORDER = ["Positive", "Negative", "Neutral"]
OBJECT_TEMPLATE = [
    ("Joy", "Positive", 2),
    ("Joy", "Neutral", 1),
    ("Anger", "Negative", 2),
    ("Anger", "Neutral", 1),
    ("Trust", "Positive", 2),
    ("Trust", "Neutral", 1),
    ("Excitement", "Positive", 1),
    ("Excitement", "Neutral", 2),
    ("Fear", "Negative", 3),
]
FORBIDDEN_PAIRS = [
    ("Joy", "Negative"),
    ("Anger", "Positive"),
    ("Trust", "Negative"),
    ("Excitement", "Negative"),
    ("Fear", "Positive"),
]
SENTIMENT_TO_TRUST = {"Positive": "Safe", "Negative": "Unsafe", "Neutral": "Questionable"}
CYCLES = 4

# --- value lists; a value's position is its numeric code ----------------------------------------
COLOURS = ["Red", "Black", "Blue", "Green", "White", "Grey", "Yellow", "Brown"]
LEVELS = ["High", "Medium", "Low"]
TRUST_VALUES = ["Safe", "Unsafe", "Questionable"]
AUDIENCES = [
    "General", "Food Lovers", "Tech Enthusiasts", "Fashionistas", "Car Enthusiasts",
    "Travelers", "Investors", "Young Adults", "Families", "Professionals",
]

# --- conditional and uniform draws --------------------------------------------------------------
CTA_ACTIONS = [
    "Order Now", "Book Now", "Shop Now", "Apply Now", "Sign Up",
    "Learn More", "Get Started", "Try Now", "Buy Now", "Subscribe",
]
CTA_NONE = "None"
CTA_NEGATIVE_NONE_WEIGHT = 70
CTA_NEGATIVE_ACTION_WEIGHT = 3
MONETARY_OPTIONS = [
    "None", "None", "None", "None", "$9.99", "$14.99", "$19.99", "$29.99", "$49.99", "$99", "$199",
    "$299", "$499", "$899", "10% off", "15% off", "20% off", "25% off", "30% off", "50% off",
    "$5 off", "$10 off",
]

# --- column order of the finished table ---------------------------------------------------------
TABLE_COLUMNS = [
    "image_path", "text", "theme", "theme_num", "sentiment", "sentiment_num", "emotion",
    "emotion_num", "dominant_colour", "dominant_colour_num", "attention_score",
    "attention_score_num", "trust_safety", "trust_safety_num", "target_audience",
    "target_audience_num", "predicted_ctr", "predicted_ctr_num", "likelihood_shares",
    "likelihood_shares_num", "keywords", "monetary_mention", "call_to_action", "object_detected",
]
ID_PATTERN = "sample_%04d.jpg"

# --- terms a text must not contain (lower-case substring match) ---------------------------------
BANNED_TERMS = [
    "iphone", "samsung", "apple", "google", "pixel", "bmw", "mercedes", "tesla", "audi", "toyota",
    "honda", "ford", "nike", "adidas", "gucci", "prada", "rolex", "amazon", "microsoft", "facebook",
    "instagram", "twitter", "starbucks", "mcdonalds", "coca-cola", "pepsi", "netflix", "spotify",
    "uber", "airbnb", "sony", "dell", "hp", "lenovo", "canon", "nikon",
]

# --- cell values a data-frame CSV reader takes as missing ---------------------------------------
FRAME_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- prompt wording: {n} = number of rows, {rows} = numbered row lines ---------------------------
TEXT_SYSTEM = (
    "You are an expert ad-copy writer.\n"
    "Write concise, emotionally resonant marketing text.\n"
    "Output ONLY valid JSON arrays/objects.\n"
    "Never use colons or apostrophes inside text strings."
)
TEXT_SYSTEM_SINGLE = (
    "You are an expert ad-copy writer.\n"
    "Write one concise, emotionally resonant marketing line.\n"
    "Reply with ONLY a JSON object. Nothing else."
)
TEXT_LINE = "Theme:{theme} | Object:{object_detected} | Emotion:{emotion} | Sentiment:{sentiment}"
TEXT_BATCH = (
    "Generate {n} ad copy lines.\n\nROWS:\n{rows}\n\n"
    "OUTPUT FORMAT - JSON array with {n} objects:\n[\n"
    '  {"id":1,"text":"Your ad copy here","keywords":"keyword1 keyword2 keyword3"},\n'
    '  {"id":2,"text":"Another ad copy","keywords":"keyword1 keyword2"}\n]\n\n'
    "RULES:\n"
    '- Each "text" must be 8-15 words\n'
    '- Each "keywords" must be 3-5 relevant words\n'
    "- Match the emotion and sentiment exactly\n"
    "- No brand names\n"
    "- Output ONLY JSON array"
)
TEXT_ANGLES = [
    "focusing on benefits", "emphasizing urgency", "highlighting quality",
    "appealing to emotions", "using social proof", "creating curiosity",
]
TEXT_SINGLE = (
    "Write ONE ad copy line {angle}.\n\n"
    "Theme: {theme}\nObject: {object_detected}\nEmotion: {emotion}\nSentiment: {sentiment}\n\n"
    "Reply with ONLY this JSON:\n"
    '{"text":"your ad copy here","keywords":"keyword1 keyword2 keyword3"}'
)

IMG_SYSTEM = (
    "You are a search query generator for image-text matching.\n"
    "Generate precise Google Image search queries.\n"
    "Output ONLY valid JSON.\n"
    "Never use colons or apostrophes inside text strings."
)
IMG_SYSTEM_SINGLE = (
    "You are a search query generator.\n"
    "Write one precise Google Image search query.\n"
    "Reply with ONLY a JSON object."
)
IMG_LINE = "{object_detected} | {theme} | {emotion} | "
IMG_CONTEXT = "Ad Copy: "
IMG_BATCH = (
    "Generate {n} Google Image search queries.\n\nROWS:\n{rows}\n\n"
    "OUTPUT FORMAT - JSON array with {n} objects:\n[\n"
    '  {"id":1,"img_desc":"your search query here"},\n'
    '  {"id":2,"img_desc":"another search query"}\n]\n\n'
    "RULES:\n"
    "- Each query 5-12 words\n"
    "- Visual descriptors only\n"
    '- Include "filetype:png" where appropriate\n'
    "- Output ONLY JSON array"
)
IMG_ANGLES = [
    "for a product catalog", "for social media advertising", "for a billboard campaign",
    "for email marketing", "for website hero image", "for print ads",
]
IMG_SINGLE = (
    "Create ONE Google Image search query {angle}.\n\n"
    "Subject: {object_detected}\nTheme: {theme}\nEmotion: {emotion}\nContext: {text}\n\n"
    "Reply with ONLY:\n"
    '{"img_desc":"your search query here"}'
)

CTA_SYSTEM = (
    "You are a marketing copy generator.\n"
    "Create compelling monetary mentions and call-to-action phrases.\n"
    "Output ONLY valid JSON."
)
CTA_SYSTEM_SINGLE = (
    "You are a marketing copy generator.\n"
    "Write precise monetary mention and CTA.\n"
    "Reply with ONLY a JSON object."
)
CTA_LINE = "Object: {object_detected} | Theme: {theme} | Emotion: {emotion} | "
CTA_CONTEXT = "Ad Copy: "
CTA_BATCH = (
    "Generate {n} monetary mentions and CTAs.\n\nROWS:\n{rows}\n\n"
    "OUTPUT FORMAT - JSON array:\n[\n"
    '  {"id":1,"monetary_mention":"Special offer 50% off","call_to_action":"Shop Now"},\n'
    '  {"id":2,"monetary_mention":"Limited time discount","call_to_action":"Buy Today"}\n]\n\n'
    "RULES:\n"
    "- monetary_mention: 3-6 words, compelling offer\n"
    "- call_to_action: 2-4 words, action-oriented\n"
    "- Output ONLY JSON array"
)
CTA_ANGLES = [
    "for an exclusive online offer", "for a seasonal promotion", "for a flash sale",
    "for a loyalty program", "for a product launch", "for clearance sale",
]
CTA_SINGLE = (
    "Create monetary mention and CTA {angle}.\n\n"
    "Product: {object_detected}\nTheme: {theme}\nEmotion: {emotion}\n\n"
    "Reply with ONLY:\n"
    '{"monetary_mention":"your offer here","call_to_action":"your CTA here"}'
)

AUDIENCE_SYSTEM = (
    "You are a marketing expert.\n"
    "Classify ads into COMMON audience categories.\n"
    "Use only broad, repeatable audience groups.\n"
    "Reply with ONLY a JSON object."
)
AUDIENCE_SYSTEM_SINGLE = (
    "You are a marketing expert.\n"
    "Classify into common audience categories only.\n"
    "Reply with ONLY a JSON object."
)
AUDIENCE_CATEGORIES = """
CATEGORIES (use EXACTLY these names):

FOOD THEME:
- Pizza Lovers: pizza related ads
- Burger Lovers: burger related ads
- Coffee Lovers: coffee related ads
- Sushi Lovers: sushi related ads
- Salad Lovers: salad, healthy food ads
- Juice Lovers: juice, smoothie ads

FASHION THEME:
- Bag Enthusiasts: bags, purses ads
- Watch Enthusiasts: watches, timepieces ads
- Shoe Lovers: shoes, footwear ads
- Jacket Lovers: jackets, outerwear ads
- Dress Lovers: dresses, formal wear ads
- Scarf Lovers: scarves, accessories ads

TECH THEME:
- Phone Enthusiasts: smartphones, mobile ads
- Laptop Enthusiasts: laptops, computers ads
- Headphone Lovers: headphones, earbuds ads
- Camera Enthusiasts: cameras, photography ads
- Tablet Users: tablets, iPad ads
- Speaker Lovers: speakers, audio ads

AUTOMOTIVE THEME:
- Car Enthusiasts: cars, sedans ads
- Motorcycle Enthusiasts: motorcycles, bikes ads
- Truck Enthusiasts: trucks, pickups ads
- SUV Enthusiasts: SUVs, crossovers ads
- Scooter Riders: scooters, mopeds ads
- Helmet Buyers: helmets, safety gear ads

TRAVEL THEME:
- Hotel Seekers: hotels, accommodations ads
- Beach Lovers: beaches, coastal ads
- Resort Lovers: resorts, vacation ads
- Luggage Shoppers: luggage, bags ads
- Passport Holders: international travel ads
- Mountain Lovers: mountains, hiking ads

FINANCE THEME:
- Card Users: credit cards, debit cards ads
- Stock Traders: stocks, trading ads
- Wallet Shoppers: wallets, accessories ads
- Coin Collectors: coins, currency ads
- Bank Customers: banking, accounts ads
- Investment Seekers: investments, funds ads

HOME THEME:
- Sofa Shoppers: sofas, couches ads
- Lamp Buyers: lamps, lighting ads
- Blender Users: blenders, kitchen ads
- Rug Shoppers: rugs, carpets ads
- Pillow Lovers: pillows, bedding ads
- Clock Enthusiasts: clocks, decor ads

GAMING THEME:
- Console Gamers: gaming consoles ads
- Controller Users: controllers, gaming ads
- Headset Gamers: gaming headsets ads
- Monitor Enthusiasts: gaming monitors ads
- Gaming Chair Buyers: gaming chairs ads
- Keyboard Enthusiasts: gaming keyboards ads

EDUCATION THEME:
- Book Readers: books, reading ads
- Pen Collectors: pens, writing ads
- Backpack Shoppers: backpacks, school bags ads
- Notebook Users: notebooks, journals ads
- Calculator Users: calculators, math tools ads
- Globe Enthusiasts: globes, geography ads

DEFAULT:
- General: unclear or mixed themes
"""
AUDIENCE_LINE = "Object: {object_detected} | Theme: {theme} | "
AUDIENCE_CONTEXT = "Ad: "
AUDIENCE_BATCH = (
    "Classify {n} ads into common audience categories.\n\n{categories}\n\nROWS:\n{rows}\n\n"
    "OUTPUT FORMAT:\n[\n"
    '  {"id":1,"target_audience":"food lovers"},\n'
    '  {"id":2,"target_audience":"travelers"}\n]\n\n'
    "STRICT RULES:\n"
    "- ONLY use categories from the allowed list above\n"
    "- Pick the SINGLE best matching category\n"
    "- 1-2 words only\n"
    "- Reply with ONLY JSON array, no explanation\n\n"
)
AUDIENCE_SINGLE = (
    "Classify this ad into ONE common audience category.\n\n{categories}\n\n"
    "Object: {object_detected}\nTheme: {theme}\nAd Copy: {text}\n\n"
    "RULES:\n"
    "- ONLY use a category from the list above\n"
    "- Pick ONE best match\n"
    "- 1-2 words only\n\n"
    'Reply ONLY: {"target_audience":"category here"}'
)

HEADLINE_SYSTEM = "You write ad headlines..."

# --- rule-based fallbacks -----------------------------------------------------------------------
TEXT_FALLBACKS = {
    ("Joy", "Positive"): "Experience pure happiness with our amazing {object_detected}",
    ("Joy", "Neutral"): "Discover the {object_detected} that brings everyday joy",
    ("Anger", "Negative"): "Tired of low quality? Our {object_detected} delivers",
    ("Anger", "Neutral"): "No more compromises with our premium {object_detected}",
    ("Trust", "Positive"): "Trusted by thousands - the reliable {object_detected}",
    ("Trust", "Neutral"): "Quality you can depend on - our {object_detected}",
    ("Excitement", "Positive"): "Get ready for the incredible {object_detected}",
    ("Excitement", "Neutral"): "Something exciting awaits - discover {object_detected}",
    ("Fear", "Negative"): "Do not miss out on this essential {object_detected}",
}
TEXT_FALLBACK_DEFAULT = "Discover the perfect {object_detected} for your {theme} needs"
IMG_MOODS = {
    "Joy": "bright natural lighting",
    "Anger": "dramatic contrast",
    "Trust": "clean studio lighting",
    "Excitement": "vibrant dynamic",
    "Fear": "moody atmosphere",
}
IMG_COLOURS_LEFT_OUT = ["none", "mixed"]
IMG_SUFFIX = "professional photography high resolution"
AUDIENCE_BY_THEME = {
    "technology": "Tech-savvy professionals",
    "fashion": "Style-conscious millennials",
    "food": "Food enthusiasts",
    "health": "Health-conscious adults",
    "travel": "Adventure seekers",
    "finance": "Young professionals",
    "home": "Homeowners",
    "beauty": "Beauty enthusiasts",
    "sports": "Fitness enthusiasts",
    "automotive": "Car enthusiasts",
    "education": "Lifelong learners",
    "gaming": "Gaming enthusiasts",
}
AUDIENCE_DEFAULT = "General consumers"
