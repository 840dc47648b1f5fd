"""Word classes of the toxicity grammar, and the weights it has before labels are seen."""

# Whole words by class. Insults in four languages; labels add stems of their own.
INSULTS = (
    "idiot idiots moron morons stupid scum loser losers trash clown clowns pathetic worthless disgusting imbecile "
    "bastard bastards bitch asshole assholes dumbass retard retards cretin vermin filth "
    "dummkopf idioten trottel vollidiot arschloch abschaum versager widerlich dreckig "
    "connard connards connasse salaud imbécile crétin minable ordure débile raté "
    "imbécil estúpido estúpida idiota idiotas cabrón basura escoria patético asqueroso inútil"
).split()
THREATS = (
    "kill destroy hurt beat stab shoot strangle murder exterminate "
    "töten umbringen vernichten erschießen verprügeln tuer détruire frapper égorger matar destruir golpear"
).split()
TARGETS = (
    "you your yourself youre he she him her they them u ya "
    "du dich dir dein ihr euch sie tu te toi vous tes votre tú ti usted ustedes ellos"
).split()
NEGATIONS = (
    "not never no isnt arent dont doesnt wasnt without nicht kein keine nie ohne "
    "ne pas jamais sans aucun ni nunca sin ningún"
).split()
REPORTS = (
    "said says say called calls quoted quote wrote reported claims claimed shouted "
    "sagte sagt nannte schrieb zitierte dit disait appelé écrit cité dijo dice llamó escribió citó"
).split()

#: Log-odds each arc adds before labels are seen; labels move them (see ``toxicity.fit``).
DEFAULT = {
    "bias": -3.5,
    "insult": 5.0,
    "negated": 2.0,
    "reported": 1.5,
    "targeted": 1.0,
    "threat": 4.0,
}
