from tripmill.cli import main

main()
