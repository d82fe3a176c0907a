"""Column -> Column building blocks: standardizers, validators and masks."""
