"""Sources, constant relations and table materialisation."""
