"""Word lists."""

from __future__ import annotations

# Spark's default English stop words, in Spark's order.
ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
)

# Tags that are spelled with a hyphen and how they are written as one token.
TAG_SPELLINGS = {
    "Sci-Fi": "SciFi",
    "Film-Noir": "Noir",
    "Talk-Show": "TalkShow",
    "Reality-TV": "RealityTV",
}

# Default polarity lexicon, our own choice of words and weights in [-1, 1].
POLARITY = {
    "amazing": 0.6, "authentic": 0.4, "awesome": 1.0, "beautiful": 0.85, "beautifully": 0.85, "best": 1.0,
    "better": 0.5, "brave": 0.6, "bright": 0.5, "brilliant": 0.9, "charming": 0.7, "classic": 0.2,
    "clever": 0.4, "compelling": 0.5, "delightful": 1.0, "easy": 0.4, "effective": 0.6, "elegant": 0.5,
    "engaging": 0.4, "enjoy": 0.4, "enjoyable": 0.5, "entertaining": 0.5, "excellent": 1.0, "exciting": 0.3,
    "fantastic": 0.4, "fascinating": 0.7, "favorite": 0.5, "fine": 0.4, "fresh": 0.3, "fun": 0.3,
    "funny": 0.25, "gentle": 0.2, "good": 0.7, "gorgeous": 0.7, "great": 0.8, "happy": 0.8,
    "heartfelt": 0.3, "hilarious": 0.5, "honest": 0.6, "impressive": 1.0, "incredible": 0.9,
    "inspiring": 0.5, "interesting": 0.5, "joy": 0.8, "love": 0.5, "loved": 0.7, "lovely": 0.5,
    "magnificent": 1.0, "masterful": 0.8, "masterpiece": 0.8, "memorable": 0.5, "moving": 0.3, "nice": 0.6,
    "original": 0.4, "outstanding": 0.5, "perfect": 1.0, "perfectly": 1.0, "pleasant": 0.7,
    "powerful": 0.3, "remarkable": 0.75, "rich": 0.4, "satisfying": 0.5, "smart": 0.2, "solid": 0.2,
    "splendid": 0.7, "strong": 0.4, "stunning": 0.5, "superb": 1.0, "superior": 0.7, "sweet": 0.35,
    "terrific": 0.5, "thrilling": 0.4, "touching": 0.3, "warm": 0.6, "winning": 0.5, "witty": 0.5,
    "wonderful": 1.0, "worth": 0.3, "worthy": 0.3,
    "absurd": -0.5, "annoying": -0.8, "awful": -1.0, "awkward": -0.6, "bad": -0.7, "bland": -0.2,
    "bleak": -0.5, "boring": -1.0, "cheap": -0.4, "clumsy": -0.4, "cold": -0.6, "confusing": -0.3,
    "cruel": -1.0, "dead": -0.2, "dire": -0.4, "disappointing": -0.6, "disgusting": -1.0, "dreadful": -1.0,
    "dreary": -0.6, "dull": -0.3, "dumb": -0.4, "empty": -0.1, "evil": -1.0, "failure": -0.3, "fails": -0.5,
    "fake": -0.5, "flat": -0.1, "foolish": -0.1, "forgettable": -0.5, "hate": -0.8, "hated": -0.9,
    "horrible": -1.0, "idiot": -0.8, "idiotic": -0.8, "insulting": -0.6, "lame": -0.5, "lazy": -0.25,
    "mediocre": -0.5, "mess": -0.2, "messy": -0.2, "miserable": -1.0, "nasty": -1.0, "offensive": -0.3,
    "painful": -0.7, "pathetic": -1.0, "pointless": -0.5, "poor": -0.4, "poorly": -0.4, "predictable": -0.2,
    "repetitive": -0.3, "ridiculous": -0.3, "sad": -0.5, "shallow": -0.3, "sick": -0.7, "silly": -0.5,
    "slow": -0.3, "stale": -0.5, "stupid": -0.8, "terrible": -1.0, "tired": -0.4, "tiresome": -0.4,
    "ugly": -0.7, "uneven": -0.2, "unfunny": -0.5, "unpleasant": -0.7, "useless": -0.5, "waste": -0.2,
    "weak": -0.4, "worse": -0.4, "worst": -1.0, "worthless": -0.8, "wrong": -0.5,
}

# Default words that strengthen or weaken the polarity word after them, and words that turn it round.
INTENSITY = {
    "absolutely": 1.5, "bit": 0.8, "completely": 1.5, "deeply": 1.4, "extremely": 1.5, "fairly": 0.9,
    "highly": 1.3, "incredibly": 1.5, "mildly": 0.7, "quite": 1.1, "rather": 0.9, "really": 1.3,
    "slightly": 0.6, "so": 1.2, "somewhat": 0.7, "too": 1.1, "totally": 1.5, "truly": 1.4, "very": 1.3,
}
NEGATORS = ("no", "not", "never", "nor", "without", "cannot", "can't", "don't", "doesn't", "didn't", "isn't", "wasn't")
