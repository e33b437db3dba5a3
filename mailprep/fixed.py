"""Fixed values.

Word lists, phrases, formats and column names that results depend on. They are data, not logic:
changing one changes which mails match. Everything else in the package reads them from here.
"""

# --- Fixed values: reply-header words, by header field -------------------------------------------
HEADER_WORDS = {
    "from": ["van", "from", "de", "von", "da", "kimden", "差出人", "发件人"],
    "sent": ["verzonden", "sent", "envoyé", "gesendet", "enviado", "inviato", "gönderildi", "送信日時", "发送时间"],
    "to": ["aan", "to", "à", "an", "para", "a", "宛先", "收件人", "kime"],
    "subject": ["onderwerp", "subject", "objet", "betreff", "asunto", "oggetto", "assunto", "件名", "主题", "konu"],
    "urgency": ["urgentie", "importance", "wichtigkeit", "importancia", "importanza", "importância", "重要度",
                "紧急程度", "önem derecesi"],
}

# --- Fixed values: words of the block header (from, sent, urgency, to, subject, in this order) ----
BLOCK_FROM = ["from", "van", "de", "von", "kimden", "差出人"]
BLOCK_SENT = ["sent", "verzonden", "envoyé", "enviado", "gesendet", "gönderildi", "发送时间"]
BLOCK_URGENCY = ["urgentie", "importance", "wichtigkeit", "önem derecesi"]
BLOCK_TO = ["to", "aan", "para", "宛先", "收件人", "kime"]
BLOCK_SUBJECT = ["subject", "onderwerp", "betreff", "件名", "konu"]

# --- Fixed values: phrases between two runs of dashes ----------------------------------------------
BANNER_PHRASES = ["original message", "forwarded message", "oorspronkelijk bericht", "mensaje original",
                  "message d'origine", "nachricht weitergeleitet", "mensagem encaminhada",
                  "転送されたメッセージ", "转发邮件", "iletilmiş mesaj"]

# --- Fixed values: "On <date> <name> wrote:" ---------------------------------------------------------
WROTE_OPENERS = ["on", "op", "le", "am", "el", "於", "于", "tarihinde"]
WROTE_VERBS = ["wrote", "geschreven", "écrit", "escribió", "scrisse", "escreveu", "yazdı",
               "さんが書きました", "写道"]

# --- Fixed values: banners and disclaimers to delete -------------------------------------------------
# (pattern, True when a dot may also stand for a line feed). The organisation named in the last one is
# a parameter of apply_discard_patterns; by default any one word is accepted there.
DISCARDS = [
    (r"ATTENTION: This is an external email.*?safe\.", True),
    (r"Please consider the environment.*?email\.", False),
    (r"This message and any attachments are intended only for the addressee", True),
    (r"https?://checkpoint\.url-protection\.com/\S+", False),
    (r"The attached message was sent.*?Sent Items folder after the upgrade\.", True),
]
CONFIDENTIALITY_NOTICE = (
    r"The information contained in this communication is confidential and may be legally privileged\. "
    r"It is intended solely for the use of the individual or the entity to whom it is addressed and the others "
    r"authorized to receive it\. "
    r"If you are not the intended recipient, you are hereby notified that any disclosure, copying, distribution "
    r"or taking any action in reliance of the contents of this information is strictly prohibited and that the "
    r"content of the message should be deleted\. "
    r"Any e-mail messages from {organisation} are given in good faith but shall not be binding nor shall they "
    r"construe any obligation\."
)

# --- Fixed values: contact details -------------------------------------------------------------------
EMAIL = r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PHONE = r"(?:phone|fax)?[\s:=\-]*\+?\(?\d{1,4}\)?[\d\s\-/.]{5,}"
DOMAIN = r"(?:https?://)?(?:www\.)?[a-z0-9\-]+\.(?:com|net|org|edu|gov|[a-z]{2,})(?:/\S*)?"
JOB_TITLES = ["manager", "director", "engineer", "officer", "coordinator", "specialist", "lead", "president",
              "consultant", "analyst", "developer", "ceo", "cto", "cfo"]
STREET_WORDS = ["straat", "street", "road", "avenue", "drive", "laan", "weg", "plaza", "parc", "port", "boulevard"]

# --- Fixed values: markup, thread marks, invisible characters ------------------------------------------
LINK_IN_BRACKETS = r"\[https?://[^\]]+\]"
CID_IN_BRACKETS = r"\[cid:[^\]]+\]"
THREAD_IN_BRACKETS = r"\[\s*thread::[a-zA-Z0-9]+(?:::)?\s*\]"
THREAD_MARK = r"thread::[^:\]\s]+(?:::)?"
INVISIBLE = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}]"

# --- Fixed values: thresholds ----------------------------------------------------------------------------
MIN_HEADER_FIELDS = 3
HEADER_SCAN_LINES = 30
MIN_LENGTH_DEFAULT = 50
MIN_LENGTH_PREPARE = 120
MIN_SENTENCE_WORDS = 8
FALLBACK_WORDS = 20
MAX_MODEL_TOKENS = 256
SMALL_DOMAIN = 30
OTHER_THRESHOLD = 500
SPLIT_RATIOS = (0.7, 0.15, 0.15)
SPLIT_SEED = 42
WEIGHT_DECAY = 0.01

# --- Fixed values: cells read as missing in delimited files -------------------------------------------------
MISSING_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
EMPTY_TOKENS = ("", "nan")
NOT_APPLICABLE = "not applicable"

# --- Fixed values: column names of the mail tables -----------------------------------------------------------
MAIL_KEY = "ParentId"
META_PREFIX = "META_"
META_KEY = "META_Id"
BODY = "TextBody"
CLEAN_BODY = "ProcessedTextBody"
COMPLAINT = "Complaint"
COMPLAINT_TYPE = "AGR_Type_of_Complaint__c"
KEPT_COLUMNS = ["TextBody", "Subject", "Priority", "AGR_Type_of_Complaint__c",
                "AGR_Extra_Information_Root_Cause__c", "AGR_Reason_for_Complaint__c", "AGR_Root_Cause__c",
                "META_SuppliedEmail", "Complaint"]

# --- Fixed values: language codes (two letters, three letters, English name) -----------------------------------
LANGUAGES = """
aa aar Afar
ab abk Abkhazian
ae ave Avestan
af afr Afrikaans
ak aka Akan
am amh Amharic
an arg Aragonese
ar ara Arabic
as asm Assamese
av ava Avaric
ay aym Aymara
az aze Azerbaijani
ba bak Bashkir
be bel Belarusian
bg bul Bulgarian
bi bis Bislama
bm bam Bambara
bn ben Bengali
bo bod Tibetan
br bre Breton
bs bos Bosnian
ca cat Catalan
ce che Chechen
ch cha Chamorro
co cos Corsican
cr cre Cree
cs ces Czech
cu chu Church Slavic
cv chv Chuvash
cy cym Welsh
da dan Danish
de deu German
dv div Dhivehi
dz dzo Dzongkha
ee ewe Ewe
el ell Modern Greek (1453-)
en eng English
eo epo Esperanto
es spa Spanish
et est Estonian
eu eus Basque
fa fas Persian
ff ful Fulah
fi fin Finnish
fj fij Fijian
fo fao Faroese
fr fra French
fy fry Western Frisian
ga gle Irish
gd gla Scottish Gaelic
gl glg Galician
gn grn Guarani
gu guj Gujarati
gv glv Manx
ha hau Hausa
he heb Hebrew
hi hin Hindi
ho hmo Hiri Motu
hr hrv Croatian
ht hat Haitian
hu hun Hungarian
hy hye Armenian
hz her Herero
ia ina Interlingua (International Auxiliary Language Association)
id ind Indonesian
ie ile Interlingue
ig ibo Igbo
ii iii Sichuan Yi
ik ipk Inupiaq
io ido Ido
is isl Icelandic
it ita Italian
iu iku Inuktitut
ja jpn Japanese
jv jav Javanese
ka kat Georgian
kg kon Kongo
ki kik Kikuyu
kj kua Kuanyama
kk kaz Kazakh
kl kal Kalaallisut
km khm Khmer
kn kan Kannada
ko kor Korean
kr kau Kanuri
ks kas Kashmiri
ku kur Kurdish
kv kom Komi
kw cor Cornish
ky kir Kirghiz
la lat Latin
lb ltz Luxembourgish
lg lug Ganda
li lim Limburgan
ln lin Lingala
lo lao Lao
lt lit Lithuanian
lu lub Luba-Katanga
lv lav Latvian
mg mlg Malagasy
mh mah Marshallese
mi mri Maori
mk mkd Macedonian
ml mal Malayalam
mn mon Mongolian
mr mar Marathi
ms msa Malay (macrolanguage)
mt mlt Maltese
my mya Burmese
na nau Nauru
nb nob Norwegian Bokmål
nd nde North Ndebele
ne nep Nepali (macrolanguage)
ng ndo Ndonga
nl nld Dutch
nn nno Norwegian Nynorsk
no nor Norwegian
nr nbl South Ndebele
nv nav Navajo
ny nya Nyanja
oc oci Occitan (post 1500)
oj oji Ojibwa
om orm Oromo
or ori Oriya (macrolanguage)
os oss Ossetian
pa pan Panjabi
pi pli Pali
pl pol Polish
ps pus Pushto
pt por Portuguese
qu que Quechua
rm roh Romansh
rn run Rundi
ro ron Romanian
ru rus Russian
rw kin Kinyarwanda
sa san Sanskrit
sc srd Sardinian
sd snd Sindhi
se sme Northern Sami
sg sag Sango
sh hbs Serbo-Croatian
si sin Sinhala
sk slk Slovak
sl slv Slovenian
sm smo Samoan
sn sna Shona
so som Somali
sq sqi Albanian
sr srp Serbian
ss ssw Swati
st sot Southern Sotho
su sun Sundanese
sv swe Swedish
sw swa Swahili (macrolanguage)
ta tam Tamil
te tel Telugu
tg tgk Tajik
th tha Thai
ti tir Tigrinya
tk tuk Turkmen
tl tgl Tagalog
tn tsn Tswana
to ton Tonga (Tonga Islands)
tr tur Turkish
ts tso Tsonga
tt tat Tatar
tw twi Twi
ty tah Tahitian
ug uig Uighur
uk ukr Ukrainian
ur urd Urdu
uz uzb Uzbek
ve ven Venda
vi vie Vietnamese
vo vol Volapük
wa wln Walloon
wo wol Wolof
xh xho Xhosa
yi yid Yiddish
yo yor Yoruba
za zha Zhuang
zh zho Chinese
zu zul Zulu
"""
UNKNOWN_CODE = "unknown"
UNKNOWN_NAME = "Unknown"
