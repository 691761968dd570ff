"""The engine's queries bound to the driver's tables, each with its SQL twin where SQL can say it."""
