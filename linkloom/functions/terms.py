"""Default word lists of the topic the engine was made for. All of them are parameters."""

# Topical terms, in file order; a repeated term counts twice.
TOPICAL_TERMS = """nuclear fukushima daiichi 2011 ōkuma reactors reaction fission core radioactivity radiation okuma
radioactive radiation radioactivity explosion isotope unscear generator""".split()

# Terms that make a link relevant, in file order.
DOCUMENT_TERMS = """nuclear fukushima reactor reaction fission core radioactivity radioactive explosions radiation
isotopes radioisotope terabecquerel explosion meltdown coolant malfunction overheated power plant shutdown repair
corrosion electrical uranium plutonium cesium containment cooldown exposure ingestion leakage radiotherapy accident
disaster iaea atomic environment lethal sl-1 impact serious kyshtym windscale radiotherapy radiological lucens
tokaimura""".split()

# The word that makes a link relevant together with one of the tokens.
ANCHOR_WORD = "nuclear"
ANCHOR_TOKENS = ["accident", "disaster", "reaction", "effect", "affect", "exposure", "leak", "explosion"]

# Terms whose occurrences in the path raise a URL in the frontier once more.
PATH_TERMS = ["nuclear", "fukushima", "radioactive", "radio-active", "radioactivity"]
