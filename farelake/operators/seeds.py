"""Seed rows of the dimensions.

Fixed values: results have to carry these codes and names as they are.
"""

RATE_CODES = [
    (1, "Standard rate", "Standard rate for trips within NYC"),
    (2, "JFK", "Flat rate to/from JFK Airport"),
    (3, "Newark", "Flat rate to/from Newark Airport"),
    (4, "Nassau or Westchester", "Negotiated fare to Nassau or Westchester"),
    (5, "Negotiated fare", "Negotiated fare for other destinations"),
    (6, "Group ride", "Group ride rate"),
]

LOCATIONS = [
    (1, "Manhattan", "Newark Airport", "EWR"),
    (2, "Queens", "Jamaica Bay", "Boro Zone"),
    (4, "Manhattan", "Alphabet City", "Yellow Zone"),
    (12, "Manhattan", "Battery Park", "Yellow Zone"),
    (13, "Manhattan", "Battery Park City", "Yellow Zone"),
    (24, "Manhattan", "Bloomingdale", "Yellow Zone"),
    (41, "Manhattan", "Central Harlem", "Boro Zone"),
    (42, "Manhattan", "Central Harlem North", "Boro Zone"),
    (43, "Manhattan", "Central Park", "Yellow Zone"),
    (45, "Manhattan", "Chinatown", "Yellow Zone"),
    (48, "Manhattan", "Clinton East", "Yellow Zone"),
    (50, "Manhattan", "Clinton West", "Yellow Zone"),
    (68, "Manhattan", "East Chelsea", "Yellow Zone"),
    (79, "Manhattan", "East Village", "Yellow Zone"),
    (87, "Manhattan", "Financial District North", "Yellow Zone"),
    (88, "Manhattan", "Financial District South", "Yellow Zone"),
    (90, "Manhattan", "Flatiron", "Yellow Zone"),
    (100, "Manhattan", "Garment District", "Yellow Zone"),
    (103, "Queens", "JFK Airport", "Airports"),
    (107, "Manhattan", "Gramercy", "Yellow Zone"),
    (113, "Manhattan", "Greenwich Village North", "Yellow Zone"),
    (114, "Manhattan", "Greenwich Village South", "Yellow Zone"),
    (116, "Manhattan", "Hamilton Heights", "Boro Zone"),
    (125, "Manhattan", "Harlem-Central", "Boro Zone"),
    (127, "Manhattan", "Hell's Kitchen North", "Yellow Zone"),
    (128, "Manhattan", "Hell's Kitchen South", "Yellow Zone"),
    (137, "Queens", "Kips Bay", "Yellow Zone"),
    (140, "Queens", "Lenox Hill East", "Yellow Zone"),
    (141, "Manhattan", "Lenox Hill West", "Yellow Zone"),
    (142, "Manhattan", "Lincoln Square East", "Yellow Zone"),
    (143, "Manhattan", "Lincoln Square West", "Yellow Zone"),
    (144, "Manhattan", "Little Italy/NoLiTa", "Yellow Zone"),
    (148, "Manhattan", "Lower East Side", "Yellow Zone"),
    (151, "Manhattan", "Manhattan Valley", "Yellow Zone"),
    (152, "Manhattan", "Manhattanville", "Boro Zone"),
    (153, "Manhattan", "Marble Hill", "Boro Zone"),
    (158, "Manhattan", "Meatpacking/West Village West", "Yellow Zone"),
    (161, "Manhattan", "Midtown Center", "Yellow Zone"),
    (162, "Manhattan", "Midtown East", "Yellow Zone"),
    (163, "Manhattan", "Midtown North", "Yellow Zone"),
    (164, "Manhattan", "Midtown South", "Yellow Zone"),
    (166, "Manhattan", "Morningside Heights", "Boro Zone"),
    (170, "Manhattan", "Murray Hill", "Yellow Zone"),
    (186, "Manhattan", "Penn Station/Madison Sq West", "Yellow Zone"),
    (194, "Manhattan", "Randalls Island", "Yellow Zone"),
    (202, "Manhattan", "Seaport", "Yellow Zone"),
    (209, "Manhattan", "SoHo", "Yellow Zone"),
    (211, "Manhattan", "Stuy Town/Peter Cooper Village", "Yellow Zone"),
    (224, "Manhattan", "Sutton Place/Turtle Bay North", "Yellow Zone"),
    (229, "Manhattan", "Times Sq/Theatre District", "Yellow Zone"),
    (230, "Manhattan", "TriBeCa/Civic Center", "Yellow Zone"),
    (231, "Manhattan", "Two Bridges/Seward Park", "Yellow Zone"),
    (232, "Manhattan", "UN/Turtle Bay South", "Yellow Zone"),
    (233, "Manhattan", "Union Sq", "Yellow Zone"),
    (234, "Manhattan", "Upper East Side North", "Yellow Zone"),
    (236, "Manhattan", "Upper East Side South", "Yellow Zone"),
    (237, "Manhattan", "Upper West Side North", "Yellow Zone"),
    (238, "Manhattan", "Upper West Side South", "Yellow Zone"),
    (239, "Manhattan", "Washington Heights North", "Boro Zone"),
    (240, "Manhattan", "Washington Heights South", "Boro Zone"),
    (243, "Manhattan", "West Chelsea/Hudson Yards", "Yellow Zone"),
    (244, "Manhattan", "West Village", "Yellow Zone"),
    (246, "Manhattan", "World Trade Center", "Yellow Zone"),
    (249, "Manhattan", "Yorkville East", "Yellow Zone"),
    (261, "Manhattan", "Yorkville West", "Yellow Zone"),
    (262, "Queens", "Astoria", "Boro Zone"),
    (263, "Queens", "Long Island City/Queens Plaza", "Boro Zone"),
]
