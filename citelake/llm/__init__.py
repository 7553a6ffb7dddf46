"""Training-data operators on texts and names; nothing outside this subpackage imports it."""
