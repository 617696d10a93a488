"""Raw table schemas, loaders / writers and the test-warehouse binding."""
