"""Fixed values of the forest cover problem. They must equal the published descriptions word for word."""

# Weights of the three shade columns (morning, noon, afternoon).
SHADE_WEIGHTS = (0.299, 0.587, 0.114)

# Description of the soil classes 1 to 40.
SOIL_DESCRIPTIONS = """1 Cathedral family - Rock outcrop complex, extremely stony.
2 Vanet - Ratake families complex, very stony.
3 Haploborolis - Rock outcrop complex, rubbly.
4 Ratake family - Rock outcrop complex, rubbly.
5 Vanet family - Rock outcrop complex, rubbly.
6 Vanet - Wetmore families - Rock outcrop complex, stony.
7 Gothic family.
8 Supervisor - Limber families complex.
9 Troutville family, very stony.
10 Bullwark - Catamount families - Rock outcrop complex, rubbly.
11 Bullwark - Catamount families - Rock land complex, rubbly.
12 Legault family - Rock land complex, stony.
13 Catamount family - Rock land - Bullwark family complex, rubbly.
14 Pachic Argiborolis - Aquolis complex.
15 unspecified in the USFS Soil and ELU Survey.
16 Cryaquolis - Cryoborolis complex.
17 Gateview family - Cryaquolis complex.
18 Rogert family, very stony.
19 Typic Cryaquolis - Borohemists complex.
20 Typic Cryaquepts - Typic Cryaquolls complex.
21 Typic Cryaquolls - Leighcan family, till substratum complex.
22 Leighcan family, till substratum, extremely bouldery.
23 Leighcan family, till substratum - Typic Cryaquolls complex.
24 Leighcan family, extremely stony.
25 Leighcan family, warm, extremely stony.
26 Granile - Catamount families complex, very stony.
27 Leighcan family, warm - Rock outcrop complex, extremely stony.
28 Leighcan family - Rock outcrop complex, extremely stony.
29 Como - Legault families complex, extremely stony.
30 Como family - Rock land - Legault family complex, extremely stony.
31 Leighcan - Catamount families complex, extremely stony.
32 Catamount family - Rock outcrop - Leighcan family complex, extremely stony.
33 Leighcan - Catamount families - Rock outcrop complex, extremely stony.
34 Cryorthents - Rock land complex, extremely stony.
35 Cryumbrepts - Rock outcrop - Cryaquepts complex.
36 Bross family - Rock land - Cryumbrepts complex, extremely stony.
37 Rock outcrop - Cryumbrepts - Cryorthents complex, extremely stony.
38 Leighcan - Moran families - Cryaquolls complex, extremely stony.
39 Moran family - Cryorthents - Leighcan family complex, extremely stony.
40 Moran family - Cryorthents - Rock land complex, extremely stony."""

# Elevation range per soil family (low, high).
FAMILY_ELEVATION = (
    ("Como family", 2000, 2750),
    ("Troutville family", 2438, 3474),
    ("Bullwark family complex", 2286, 3048),
    ("Rogert family", 2300, 3300),
    ("Leighcan family", 2133, 3657),
    ("Vanet family", 2370, 2590),
    ("Moran family", 1980, 3350),
    ("Cathedral family", 1890, 3000),
    ("Bross family", 3048, 4267),
    ("Gothic family", 2200, 3200),
    ("Ratake family", 2286, 3048),
    ("Gateview family", 2316, 3048),
    ("Legault family", 2286, 3474),
    ("Leighcan family complex", 2133, 3657),
    ("Catamount family", 2438, 3505),
)
