"""Common words of the languages that text rules know."""

# Frequent function words of each language.
STOP_WORDS = {
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die du durch ein eine einem einen einer er es "
    "für hat ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor "
    "war was wenn werden wie wir wird zu zum zur",
    "en": "a about after all also an and any are as at be been but by can could do for from had has have he her his how i if "
    "in into is it its more no not of on one only or other our out she so some than that the their them there they this to "
    "up was we were what when which who will with would you",
    "es": "a al algo ante como con cuando de del desde donde dos e el ella en entre era es esta este ha hasta hay la las le lo "
    "los más me mi muy no nos o para pero por porque que se si sin sobre son su sus también un una uno y ya",
    "fr": "à ai au aussi aux avec ce ces cette comme dans de des du elle en est et été être eux fait il ils je la le les leur "
    "lui mais me même mon ne nos nous on ont ou où par pas plus pour qu que qui sa se ses son sont sur ta te tout tu un une "
    "vous y",
}

ANY_LANGUAGE = frozenset(w for words in STOP_WORDS.values() for w in words.split())
