"""Small inlined fixtures and expected results (see FIXTURES.md)."""

# The 18-line sales sample, in file order.
SALES_SAMPLE = """01-06-2018,June,Category5,Bat,12
01-06-2108,June,Category4,Perfume,10
13-07-2018,July,Category1,Television,50
24-06-2018,June,Category4,Shirt,38
18-06-2018,June,Category5,Bat,41
01-08-2018,August,Category5,PC,32
11-06-2018,June,Category2,Laptop,39
04-06-2018,June,Category1,PC,14
26-08-2018,August,Category4,Pendrive,42
12-06-2018,June,Category2,Tablet,41
25-08-2018,August,Category1,Shirt,34
17-07-2018,July,Category5,Steamer,27
03-08-2018,August,Category5,Socks,38
06-07-2018,July,Category1,Pendrive,12
13-06-2018,June,Category2,Shirt,20
11-08-2018,August,Category2,PC,16
14-06-2018,June,Category2,Watch,17
09-08-2018,August,Category5,Steamer,50""".splitlines()

# Running average per month of the first 8 sales lines.
RUNNING_AVG_FIRST8 = [("June", 12.0), ("June", 11.0), ("July", 50.0), ("June", 20.0),
                      ("June", 25.25), ("August", 32.0), ("June", 28.0),
                      ("June", 25.666666666666668)]

# The 43-line parity input, in file order.
NUMBERS = [454, 565, 45654, 767, 889, 78, 7689, 679, 68, 67, 788, 70679, 787567, 688, 467,
           98, 567, 54, 7008, 8679, 546, 78908, 4567, 67, 467, 457, 76, 568, 578, 578, 78,
           79, 54, 634, 86, 89, 6, 7467, 86, 6, 8, 78, 7]

# Prefix-N word counts of the word-count golden output.
WORD_COUNTS = {"Nana": 2, "Nanaho": 2, "Nate": 1, "Nicole": 7, "Nipul": 6, "Nipun": 2,
               "Noel": 1, "Noman": 12}
OTHER_NAMES = ["Joyce", "Sayuri", "Frances", "Kazuko", "Wanda", "Erika", "Virginie", "nina"]
