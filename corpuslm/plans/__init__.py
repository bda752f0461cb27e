"""How the operators stay safe at volume: size checks, hot keys, numbering, written tables."""
