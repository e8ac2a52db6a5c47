"""Column functions: Column in, Column out. They compose inside one select."""
