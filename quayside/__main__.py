from quayside.cli import main

main()
